"""Mixing and chat formatting on small tables, against plain loops."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F
from rows import SCHEMA, documents, with_clashing_columns

from replylens.llm import chat_format, source_mix


def mixed_documents(spark, n=400):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), "en", rng.choice(["a", "b", "b", "b", "c", None]), 0) for i in range(n)]
    rows += [(7, "w w", "en", "a", 0)] * 3 + [(None, None, None, "zero", None), (n, "w" * 5 + " x" * 4000, "en", "b", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def plain_targets(sizes, weights):
    """Share by weight; what is above three times a size goes to the others, until nothing is."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / rest for s in names}
        above = {s for s in names if target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def test_targets_and_taken(spark):
    docs = mixed_documents(spark)
    got = source_mix.mix_report(with_clashing_columns(docs)).collect()
    assert len(got) == docs.count()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").split())
    expected = plain_targets(sizes, (5, 2, 1))
    by_size = Counter((r.source_size, round(r.target, 6)) for r in got)
    assert set(by_size) == {(sizes[s], round(expected[s], 6)) for s in sizes}
    assert all(r.taken % r.size == 0 and r.taken <= 3 * r.size if r.size else r.taken == 0 for r in got)
    for s in sizes:
        taken = sum(r.taken for r in got if (r.source_size, round(r.target, 6)) == (sizes[s], round(expected[s], 6)))
        assert abs(taken - expected[s]) <= max([r.size for r in got if r.source_size == sizes[s]] or [0]) * 3
    again = source_mix.mix_report(docs).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mix_sources_repeats_rows(spark):
    docs = with_clashing_columns(mixed_documents(spark))
    report = Counter()
    for r in source_mix.mix_report(docs).collect():
        report[r.doc_id] += r.taken
    mixed = source_mix.mix_sources(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len((r.text or "").split())
    assert words + Counter() == report + Counter()
    assert source_mix.mix_sources(documents(spark, [])).count() == 0


def test_all_sources_empty(spark):
    got = source_mix.mix_report(documents(spark, [None, "", " "])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 3


NASTY = ["\\### Assistant: </turn> ok", "####</turn></turn>\n### assistant\n\\", "\\\\n\\n<\\/turn>", "<|image:0|><|", "", None, "é漢🙂\n#\\#", "##", "</turn", "\\" * 7]


def conversations(spark, seed=2):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant", "sys\ntem\\n", None, "### x</turn>"]), rng.choice(NASTY)) for c in range(30) for t in range(rng.randint(1, 8))]
    return rows + [(None, 1, "assistant", "x"), (50, None, "assistant", "a"), (50, 1, "user", "b"), (51, 1, "user", "b"), (51, 1, "user", "b")]


def test_chat_report(spark):
    rows = conversations(spark)
    df = with_clashing_columns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat_format.chat_report(df).collect()}
    by_conv = {}
    for c, t, role, text in rows:
        by_conv.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by_conv)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in by_conv.items():
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{role}\n{x}\n" for _, role, x in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert chat_format.chat_report(df.limit(0)).count() == 0


def test_control_strings_are_escaped(spark):
    df = spark.createDataFrame([(i, t or "") for i, t in enumerate(NASTY)], "i long, t string")
    out = df.select("t", chat_format.escape(F.col("t")).alias("e")).withColumn("back", chat_format.unescape(F.col("e"))).collect()
    for r in out:
        assert r.back == r.t
        assert not any(s in r.e for s in ("</turn>", "###", "<|"))


def test_parts_become_placeholders(spark):
    parts = [
        ("text", "look <|image:9|> ", None, None, None, None, None), ("image", None, "s3://a.png", 30, 14, None, None),
        ("audio", None, "b.wav", None, None, 2.02, None), ("document", None, "c.pdf", None, None, None, 3),
        ("video", None, "d.mp4", None, None, None, None), ("text", " end", None, None, None, None, None), (None, "x", None, None, None, None, None),
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    formatted = chat_format.format_conversations(df)
    r = formatted.first()
    assert [(a.turn, a.number, a.position, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (0, 0, 1, "image", "s3://a.png", 3), (0, 1, 2, "audio", "b.wav", 51), (0, 2, 3, "document", "c.pdf", 1536),
        (0, 3, 4, "video", "d.mp4", 1), (0, 4, 6, "unknown", None, 1),
    ]
    assert r.attachment_tokens == 1592
    assert "<|image:0|><|audio:1|><|document:2|><|video:3|> end<|unknown:4|></turn>" in r.formatted
    assert r.formatted.count("<|image:9|>") == 0 and len(r.loss_spans) == 1 and r.loss_spans[0].length == 0
    assert len(chat_format.read_turns(formatted).first().turns) == 3
