"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A document's set are its distinct shingles of `WIDTH` words. Of each of `HASHES` hash functions the
`BITS` low bits of the least value are a symbol of the signature; signatures are stored as BITS words
of HASHES bits, so that their distance, the number of different symbols, is one popcount.

Signatures are cut into `CHUNKS` chunks. Of two signatures with at most `DISTANCE` different symbols
one chunk pair has at most DISTANCE // CHUNKS = 1 differences (pigeonhole), so both signatures agree in
a chunk less one symbol. Each signature is entered under each chunk with each of its symbols left
out, HASHES keys in all; all pairs within DISTANCE share a key. A pair of similarity 0.85 is beyond
DISTANCE with probability P(Binomial(64, 0.15) > 25) < 1e-6. For another least similarity `cuts` finds
the chunks and the distance that keep this bound. What is linked is confirmed on the full sets.

Groups are never expanded into all pairs. Equal sets are one node. In a bucket all members are first
compared with the one that meets most others, which then leaves the bucket; links found are contracted to components,
and in later rounds only buckets that still hold several components compare another member with
those of other components. What is left after ROUNDS rounds may be near misses in great number, such
as texts around one long passage; there the members of all such buckets are compared across
components under a prefix filter (see `all_across`), which loses no similar pair. So every pair
within DISTANCE that can be linked is either compared or already in one component. Hot buckets are
skewed join keys, which the adaptive execution splits.

Defined cases: words are what is between ASCII white space, A-Z lower-cased; fewer words than WIDTH make
one shingle of the whole sequence; null and blank texts have an empty set and no links; rows that
repeat a doc_id are compared each by its own text, and have the same id; a null doc_id is only its
component's id if all ids are null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replylens.llm import tokens
from replylens.llm.components import components
from replylens.llm.keeping import only_kept
from replylens.session import cut_lineage

WIDTH = 5
HASHES, BITS = 64, 16
CHUNKS, DISTANCE = 13, 25
LEAST_PERCENT = 85
# Share of similar pairs that may be beyond the distance.
MISSED = 1e-6
ROUNDS = 1
ROWS = 4096


def cuts(least_percent: int) -> tuple[int, int]:
    """Fewest chunks, and their distance, that miss a pair of the least similarity with less than MISSED."""
    differs = 1 - least_percent / 100
    for chunks in range(1, HASHES // 2):
        distance = 2 * chunks - 1
        beyond = range(distance + 1, HASHES + 1)
        if math.fsum(math.comb(HASHES, k) * differs**k * (1 - differs) ** (HASHES - k) for k in beyond) < MISSED:
            return chunks, distance
    return HASHES // 2, HASHES - 1


def shingles_of(texts, width: int = WIDTH):
    """Yields the sorted distinct 64-bit shingle hashes of each text."""
    for _, ends, hashes in tokens.token_hashes(texts, tokens.WORDS):
        joined = hashes
        for k in range(1, width):
            joined = tokens.mix(joined[: len(hashes) - k] * tokens.BASE + hashes[k:])
        start = 0
        for end in ends:
            n = end - start
            if n >= width:
                yield np.unique(joined[start : end - width + 1])
            elif n:
                # The length keeps a short sequence apart from every shingle.
                short = np.uint64(n)
                for h in hashes[start:end]:
                    short = tokens.mix(np.array([short], np.uint64) * tokens.BASE + h)[0]
                yield np.array([short], np.uint64)
            else:
                yield np.empty(0, np.uint64)
            start = end


def hash_family(n: int):
    numbers = tokens.mix(np.arange(1, 3 * n + 1, dtype=np.uint64) * tokens.BASE)
    return numbers[:n], numbers[n : 2 * n] | np.uint64(1), numbers[2 * n :] | np.uint64(1)


def symbols_of(shingles: np.ndarray, family) -> np.ndarray:
    """The low BITS of the least hash per function, over any number of shingles."""
    add, first, second = family
    least = np.full(len(add), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), ROWS):
        x = (shingles[at : at + ROWS, None] ^ add) * first
        x ^= x >> np.uint64(32)
        x *= second
        np.minimum(least, x.min(axis=0), out=least)
    return (tokens.mix(least) & np.uint64((1 << BITS) - 1)).astype(np.uint16)


def planes_of(symbols: np.ndarray) -> np.ndarray:
    """(rows, HASHES) symbols to (rows, BITS) words; bit i of word j is bit j of symbol i."""
    bits = (symbols[:, None, :] >> np.arange(BITS, dtype=np.uint16)[None, :, None]) & np.uint16(1)
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view(np.int64)[:, :, 0]


def symbols_from(planes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(planes[:, :, None].view(np.uint8), axis=2, bitorder="little").astype(np.uint16)
    return (bits << np.arange(BITS, dtype=np.uint16)[None, :, None]).sum(axis=1, dtype=np.uint16)


def chunk_bounds(chunks: int = CHUNKS) -> list[tuple[int, int]]:
    edges = [HASHES * i // chunks for i in range(chunks + 1)]
    return list(zip(edges, edges[1:], strict=False))


def keys_of(symbols: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """(rows, HASHES) keys: column i is the chunk of symbol i without symbol i."""
    keys = np.empty(symbols.shape, np.uint64)
    wide = symbols.astype(np.uint64)
    for start, end in chunk_bounds(chunks):
        for left_out in range(start, end):
            key = np.full(len(symbols), left_out + 1, np.uint64)
            for i in range(start, end):
                if i != left_out:
                    key = tokens.mix(key * tokens.BASE + wide[:, i] + np.uint64(1))
            keys[:, left_out] = key
    return keys.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, digest of the set, planes) of every row."""

    def run(batches):
        import pyarrow as pa

        family = hash_family(HASHES)
        for batch in batches:
            counts, digests, symbols = [], [], []
            for shingles in shingles_of(batch.column(2).to_pylist()):
                counts.append(len(shingles))
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                symbols.append(symbols_of(shingles, family))
            planes = planes_of(np.array(symbols, np.uint16).reshape(len(symbols), HASHES))
            offsets = pa.array(np.arange(len(symbols) + 1) * BITS, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(planes.ravel(), pa.int64()))
            columns = [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n_shingles", "digest", "planes"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_key long, n_shingles long, digest binary, planes array<long>"
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


def bucket_keys(nodes: DataFrame, chunks: int = CHUNKS) -> DataFrame:
    """(node, key): HASHES rows per node."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            planes = batch.column(1).flatten().to_numpy().reshape(-1, BITS)
            for at in range(0, len(planes), ROWS):
                keys = keys_of(symbols_from(np.ascontiguousarray(planes[at : at + ROWS])), chunks)
                ids = np.repeat(batch.column(0).to_numpy()[at : at + ROWS], HASHES)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.ravel())], names=["node", "key"])

    return nodes.select("node", "planes").mapInArrow(run, "node long, key long")


def shingle_sets(rows: DataFrame) -> DataFrame:
    """(node, shingles) of `rows` (node, text)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = list(shingles_of(batch.column(1).to_pylist()))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            flat = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["node", "shingles"])

    return rows.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def distance(a: str, b: str):
    """Different symbols of two signatures."""
    different = F.col(a)[0].bitwiseXOR(F.col(b)[0])
    for i in range(1, BITS):
        different = different.bitwiseOR(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return F.bit_count(different)


def near(pairs: DataFrame, signatures: DataFrame, most: int = DISTANCE) -> DataFrame:
    """`pairs` (a, b) whose signatures have at most `most` different symbols."""
    of = lambda name: signatures.select(F.col("node").alias(name), F.col("planes").alias(f"planes_{name}"))
    joined = pairs.join(of("b").hint("merge"), "b").join(of("a").hint("merge"), "a")
    return joined.filter(distance("planes_a", "planes_b") <= most).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, least_percent: int) -> DataFrame:
    """`pairs` (a, b) with `linked`: whether their full sets are similar enough."""
    of = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"set_{name}"))
    joined = pairs.join(of("b").hint("merge"), "b").join(of("a").hint("merge"), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return joined.select("a", "b", (100 * common >= least_percent * union).alias("linked"))


def links_of(tested: DataFrame) -> DataFrame:
    return tested.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))


def all_across(members: DataFrame, sets: DataFrame, least_percent: int) -> DataFrame:
    """(a, b): all pairs of `members` (node, component) in different components that can be similar enough.

    With shingles in one order, rarest first, the first one that two similar sets share stands early in
    both: at most size - overlap others come before it. So each set enters under its first shingles
    only, and a pair comes out only if the place of a shared one leaves room for the overlap it needs.
    Texts that share a long passage meet in buckets, but what is rare in each of them is its own.
    """
    left = cut_lineage(members.select("node", "component").distinct())
    postings = sets.join(left.select("node"), "node").select("node", F.explode("shingles").alias("shingle"))
    rarity = cut_lineage(postings.groupBy("shingle").agg(F.count("*").alias("sets")))
    ordered = (
        postings.join(rarity.hint("merge"), "shingle")
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("sets", "shingle"))).alias("ordered"))
        .withColumn("size", F.size("ordered"))
    )
    first = F.expr(f"slice(ordered, 1, CAST(size - ceil({least_percent} * size / 100) + 1 AS INT))")
    prefixes = cut_lineage(
        ordered.join(left, "node")
        .select("node", "component", "size", F.posexplode(first).alias("place", "one"))
        .select("node", "component", "size", "place", F.col("one.shingle").alias("shingle"))
    )
    side = lambda name: prefixes.select("shingle", *[F.col(c).alias(f"{c}_{name}") for c in ("node", "component", "size", "place")])
    overlap = F.expr(f"ceil({least_percent} * (size_a + size_b) / {100 + least_percent})")
    fits = (F.col("place_a") + overlap <= F.col("size_a")) & (F.col("place_b") + overlap <= F.col("size_b"))
    across = side("a").join(side("b").hint("merge"), "shingle").filter("component_a < component_b").filter(fits)
    return across.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def grouped(docs: DataFrame, least_percent: int = LEAST_PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key, `kept`, and `first` of every row.

    `kept` holds for all rows with the least id of their component, `first` for one text of that id only.
    """
    chunks, most = cuts(least_percent)
    sketched = cut_lineage(sketches(docs))
    # Null ids come last.
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    nodes = cut_lineage(
        sketched.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("planes").alias("planes"), F.min(least).alias("least"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    signatures = nodes.select("node", "planes")
    keys = bucket_keys(nodes, chunks)
    buckets = cut_lineage(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    met = cut_lineage(keys.join(buckets.hint("merge"), "key"))
    # The node that meets most others, the original of many copies, is compared with them first.
    meetings = met.groupBy("node").agg(F.sum("n").alias("meetings"))
    ranked = met.join(meetings, "node").select("key", "node", F.struct("meetings", "node").alias("rank"))
    centers = cut_lineage(ranked.groupBy("key").agg(F.max("rank").alias("first")).select("key", F.col("first.node").alias("center")))
    shared = cut_lineage(ranked.join(centers.hint("merge"), "key"))
    # Only nodes that share a bucket can ever be asked for their sets.
    sets = cut_lineage(shingle_sets(texts_of(docs, nodes, shared)))
    others = shared.filter("node <> center")
    pairs = others.select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    tested = cut_lineage(confirmed(near(pairs, signatures, most), sets, least_percent))
    stars = components(links_of(tested))
    # A member that was compared with all others of its bucket leaves it.
    members = others.select("key", "node", "rank")
    for turn in range(rounds + 1):
        placed = members.join(stars, "node", "left").withColumn("component", F.coalesce("component", "node"))
        next_one = F.max(F.struct("rank", "component"))
        mixed = cut_lineage(
            placed.groupBy("key")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"), next_one.alias("c"))
            .filter("low <> high")
            .select("key", F.col("c.rank.node").alias("center"), F.col("c.component").alias("center_component"))
        )
        if mixed.isEmpty():
            break
        members = cut_lineage(placed.join(mixed.hint("merge"), "key"))
        if turn < rounds:
            across = members.filter("component <> center_component")
            found = across.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()
        else:
            found = all_across(members, sets, least_percent)
        known = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        fresh = found.join(known.hint("merge"), ["a", "b"], "left_anti")
        fresh = cut_lineage(confirmed(near(fresh, signatures, most), sets, least_percent))
        tested = tested.unionByName(fresh)
        more = links_of(fresh)
        if not more.isEmpty():
            stars = components(stars.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more))
        members = members.filter("node <> center").select("key", "node", "rank")
    placed = nodes.select("digest", "node").join(stars, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = (
        nodes.select("node", "least").join(placed.select("node", "component"), "node")
        .groupBy("component").agg(F.min("least").alias("first"))
    )
    owners = placed.join(first, "component").select("digest", F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("_key"))
    linked = sketched.select("doc_id", "text_key", "n_shingles", "digest").filter("n_shingles > 0").join(owners, "digest")
    blank = sketched.filter("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "_key": F.col("text_key")})
    columns = ("doc_id", "n_shingles", "component_id", "text_key", "_key")
    result = linked.select(*columns).unionByName(blank.select(*columns))
    of_first_id = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return result.select("doc_id", "n_shingles", "component_id", "text_key", of_first_id.alias("kept"), (of_first_id & (F.col("text_key") == F.col("_key"))).alias("first"))


def near_duplicates(docs: DataFrame, least_percent: int = LEAST_PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_key of every row."""
    return grouped(docs, least_percent, rounds).drop("first")


def texts_of(docs: DataFrame, nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """(node, text) of the nodes that share a bucket: the text of one document each."""
    wanted = shared.select("node").distinct().join(nodes.select("node", "least"), "node")
    wanted = wanted.select("node", F.col("least.doc_id").alias("_id"), F.col("least.text_key").alias("_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    return docs.select("doc_id", "text").join(wanted.hint("merge"), same).dropDuplicates(["node"]).select("node", "text")


def drop_near_copies(docs: DataFrame, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """The rows of `docs` that stay, one document of each component, with its columns."""
    decided = grouped(docs, least_percent).select("doc_id", "text_key", F.col("first").alias("kept"))
    return only_kept(docs, decided)
