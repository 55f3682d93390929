"""Periodic runs of words in documents, found with minimizers at several scales.

A run is a stretch of consecutive words with smallest period q, at least `LEAST_TIMES` * q and at least
`LEAST_WORDS` words long, that no neighbouring word extends. Periods below `SHORT` are found by
comparing every word with the one q before it (a lag scan). Longer ones belong to the scale P with
P <= q < 2P: grams of 2P words get names (equal names, equal grams: built by doubling, without
hashes), and every gram whose mixed name is least in some window of P grams is a minimizer. Two windows
that lie q words apart fit into a run of four periods, so their minima are two minimizers with one
name; grams at least as long as the period do not recur within it, so these two follow each other among
the minimizers with that name. Every such pair P to 2P apart is a seed: it is extended as far as the
words agree at that distance, which proves or refutes a run. A stretch that is periodic at several
multiples of its period is reported at the smallest one. Nothing is missed and nothing is estimated.

A scale costs a sort of the words of the documents that are long enough for it, and its seeds are at
most about 2/P of the words, so a text of n words costs about n log^2 n. The words of many documents
are handled at once, with a separator of its own after each. No shuffle takes place; memory is bounded
by `CHUNK` words or the longest single text.

Defined cases: null, empty and blank texts have no words and no runs; words are
`[^\\x20\\x09-\\x0D]+` and are compared as bytes; rows that repeat are rows of their own; an empty table
gives an empty result; other columns are kept or ignored as the caller says.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replylens.llm.tokens import mix

LEAST_TIMES, LEAST_WORDS = 4, 6
SHORT = 8  # a power of two: the first scale
CHUNK = 400_000
RUN = "struct<start:long,length:long,period:long>"
OUT = f"runs array<{RUN}>, best {RUN}, collapsed string"


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _sliding(choose, values: np.ndarray, window: int) -> np.ndarray:
    """`choose` over every window; `window` is a power of two."""
    span = 1
    while span < window:
        values = choose(values[:-span], values[span:])
        span *= 2
    return values


def minimizers(names: np.ndarray, window: int) -> np.ndarray:
    """Positions whose name is least, in mixed order, in some window that holds them."""
    if len(names) < window:
        return np.empty(0, np.int64)
    order = mix(names.astype(np.uint64))
    least = _sliding(np.minimum, order, window)
    edge = np.zeros(window - 1, np.uint64)
    return np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, least, edge]), window) == order)


def _agreement(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from `at` on, in direction `step`, equal those `lag` further."""
    agreed, block = 0, 32
    while True:
        if step > 0:
            first = words[at + agreed : at + agreed + block]
            second = words[at + lag + agreed : at + lag + agreed + block]
            first = first[: len(second)]
        else:
            end = at + 1 - agreed
            first, second = words[max(0, end - block) : end][::-1], words[max(0, end - block) + lag : end + lag][::-1]
        differs = first != second
        if not len(differs):
            return agreed
        where = int(differs.argmax())
        if differs[where]:
            return agreed + where
        agreed += len(differs)
        block *= 2


def _lag_scan(words: np.ndarray, lag: int) -> Iterator[tuple[int, int, int]]:
    if len(words) <= lag:
        return
    edges = np.diff(np.concatenate([[0], (words[:-lag] == words[lag:]).view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + lag
    long_enough = ends - starts >= max(LEAST_WORDS, LEAST_TIMES * lag)
    for start, end in zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
        yield start, end, lag


def _seeded(words: np.ndarray, names: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    chosen = minimizers(names, scale)
    order = np.argsort(names[chosen], kind="stable")
    at = chosen[order]
    lags = at[1:] - at[:-1]
    seeds = (names[at[1:]] == names[at[:-1]]) & (lags >= scale) & (lags < 2 * scale)
    starts, lags = at[:-1][seeds], lags[seeds]
    order = np.lexsort((starts, lags))
    known_lag, known_end = 0, 0
    for start, lag in zip(starts[order].tolist(), lags[order].tolist(), strict=True):
        if lag == known_lag and start < known_end:
            continue
        begin = start - _agreement(words, start - 1, lag, -1) if start else 0
        known_lag, known_end = lag, start + _agreement(words, start, lag, 1)
        if known_end + lag - begin >= max(LEAST_WORDS, LEAST_TIMES * lag):
            yield begin, known_end + lag, lag


def find_runs(documents: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs per document, by start, then period; words are numbers from 0 on."""
    sizes = np.array([len(d) for d in documents], np.int64)
    # Longest first, so that the documents that are long enough for a scale are a prefix.
    by_size = np.argsort(-sizes, kind="stable")
    above = max((int(d.max()) for d in documents if len(d)), default=0) + 1
    parts = []
    for place, d in enumerate(by_size.tolist()):
        parts += [documents[d], [above + place]]
    words = np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes[by_size] + 1)])
    periods: dict[tuple[int, int], int] = {}

    def found(runs):
        for start, end, period in runs:
            if period < periods.get((start, end), period + 1):
                periods[start, end] = period

    for lag in range(1, SHORT):
        found(_lag_scan(words, lag))
    names, gram, scale = words, 1, SHORT
    while True:
        within = int(offsets[np.count_nonzero(sizes >= LEAST_TIMES * scale)])
        if not within:
            break
        words, names = words[:within], names[: within - gram + 1]
        while gram < 2 * scale:
            names = _ranks(names[:-gram] * (int(names.max()) + 1) + names[gram:])
            gram *= 2
        found(_seeded(words, names, scale))
        scale *= 2
    runs: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    for (start, end), period in periods.items():
        place = int(np.searchsorted(offsets, start, side="right")) - 1
        runs[by_size[place]].append((start - int(offsets[place]), end - start, period))
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in runs]


def _row(words: list[bytes], runs: list[tuple[int, int, int]]) -> dict:
    fields = [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]
    best = min(fields, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]), default=None)
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return {"runs": fields, "best": best, "collapsed": b" ".join(words).decode()}


def _detect(texts: list[list[bytes]]) -> list[dict]:
    known: dict[bytes, int] = {}
    numbers = [np.array([known.setdefault(w, len(known)) for w in words], np.int64) for words in texts]
    return [_row(words, runs) for words, runs in zip(texts, find_runs(numbers), strict=True)]


def collapse_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep`, runs, best (greatest length / period; ties: first, then shortest period) and collapsed text.

    The collapsed text has the words outside of runs and the first period of each run, unless that lies
    inside another run beyond the first period there, joined by one space.
    """

    def detect(batches):
        import pyarrow as pa

        kinds = pa.struct([pa.field(n, pa.int64()) for n in ("start", "length", "period")])
        schema = {"runs": pa.list_(kinds), "best": kinds, "collapsed": pa.string()}
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary())
            rows, waiting, size = [], [], 0
            for value in texts:
                waiting.append((value.as_py() or b"").split())
                size += len(waiting[-1])
                if size >= CHUNK:
                    rows += _detect(waiting)
                    waiting, size = [], 0
            rows += _detect(waiting)
            made = [pa.array([r[name] for r in rows], kind) for name, kind in schema.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=[*keep, *schema])

    given = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_words_of"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[: len(keep)])
    return given.mapInArrow(detect, f"{kept}, {OUT}")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts made periodic from some word on, by a checksum of doc_id.

    h = crc32(decimal doc_id), g = h div 10: if h % 10 is 0, words i >= a become word a + (i - a) % p with
    a = g % n and p = 1 + (n - a) div (3 + g % 8). Texts with a null doc_id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.coalesce(F.col("text"), F.lit(""))
    words: Column = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", text.alias("text"), h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, words)
    )
    g, n = F.expr("h div 10"), F.size("words")
    chosen = (
        chosen.withColumn("a", F.when(n > 0, g % n).cast("int"))
        .withColumn("p", F.expr("cast(1 + (size(words) - a) div (3 + (h div 10) % 8) as int)"))
        .withColumn(
            "made",
            F.expr("array_join(transform(words, (w, i) -> if(i < a, w, element_at(words, a + (i - a) % p + 1))), ' ')"),
        )
    )
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), F.col("made")).otherwise(F.col("text")).alias("text"))


def runs_report(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the run of greatest exponent, and digests of runs and collapsed text."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    exponent = F.expr("1000 * best.length div best.period")
    return collapse_runs(docs).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        exponent.alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
