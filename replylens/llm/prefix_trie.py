"""Prefix trie of conversations by the splitter-skeleton method.

A conversation becomes a path: one symbol of fixed width per turn, made of a 128-bit digest of role and
text and the size of the text. Equal turns have equal symbols, so the order of paths as bytes is an order
of the trie: the members of a node are neighbours. Texts never leave the task that reads them.

Paths, with the conversation's id to tell copies apart, are dealt to shards by splitters taken from a
sample. A splitter is the shortest prefix that separates two neighbours of the sample, or a whole path with
an id between two copies. A node whose members lie on both sides of a splitter is a prefix of that splitter.
So the trie of all splitters, the *skeleton*, holds every node that more than one shard sees. It is broadcast.
Each shard is sorted and walked once with a stack: every node outside of the skeleton is finished there,
subtree included; skeleton nodes give one partial row per shard. Partial rows are summed by an aggregation,
then up the skeleton. Where equal conversations are a third of all rows, splitters with ids cut them
into many shards.

`ends_sha256` hashes the ids of conversations that end at a node in one sequence. In a shard these ids are
neighbours and in order. For skeleton nodes shards emit them in blocks of `BLOCK` ids, and one task per node
hashes the blocks in order, one after another: a digest can't be put together from parts, so this is sequential,
but over a row per block only.

Bounds: `SHARD` conversations a shard (about); `PER_SHARD` sampled paths per shard go to the driver, at most
`SPLITTER` turns each; the skeleton has at most `SKELETON` nodes: splitters that would need more are left
out, which makes shards larger but nothing else. Conversations that agree in more than `SPLITTER` turns share
a shard. The stack holds one frame per turn of the longest path, and the finished children of its open nodes.

Defined cases: null role and text are empty; turns are ordered by turn (null first), ties by role, then by
digest (so that texts need not be shuffled); rows that repeat are turns of their own; rows with a null conv_id take no part; an empty table has no
nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replylens.session import cut_lineage

DIGEST, SIZE = 16, 4
WIDTH = DIGEST + SIZE
SHARD, PER_SHARD, SPLITTER, SKELETON, BLOCK = 50_000, 32, 1024, 1_000_000, 1024
NO_ENDS = hashlib.sha256().hexdigest()
SMALLEST = -(1 << 63)
NODE, PARTIAL, ENDS = 0, 1, 2
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
WALKED = (
    "kind int, sid long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends string"
)


def turn_symbol(role: Column, text: Column) -> Column:
    """Digest of role and text and number of UTF-8 bytes of the text, in hexadecimal."""
    told_apart = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.octet_length(text)), 2 * SIZE, "0")
    return F.concat(F.substring(F.sha2(told_apart.cast("binary"), 256), 1, 2 * DIGEST), size)


def conversation_turns(messages: DataFrame) -> DataFrame:
    """(conv_id, turns): the symbols of every conversation in order; 60 bytes or so a turn are shuffled."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = messages.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", role.alias("role"), turn_symbol(role, text).alias("symbol")
    )
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "symbol")))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda t: t["symbol"]).alias("turns"))


def with_shared_heads(turns: DataFrame) -> DataFrame:
    """Conversation c with the first h turns of conversation c - c % 5 in place of its own.

    h is crc32(decimal c) % 9; all turns if there are fewer, none if that conversation is absent.
    """
    c = F.col("conv_id")
    heads = turns.filter(c % 5 == 0).select(c.alias("head_id"), F.slice("turns", 1, 8).alias("head"))
    none = F.array().cast("array<string>")
    h = (F.crc32(c.cast("string").cast("binary")) % 9).cast("int")
    return (
        turns.withColumn("h", h)
        .withColumn("head_id", c - c % 5)
        .join(heads, "head_id", "left")
        .select(
            "conv_id",
            F.concat(
                F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))),
            ).alias("turns"),
        )
    )


def _separator(before: tuple[bytes, int], after: tuple[bytes, int]) -> tuple[bytes, int] | None:
    """A key above `before` and not above `after`; None if both agree as far as splitters go."""
    (a, _), (b, number) = before, after
    if a == b:
        return None if len(b) > SPLITTER * WIDTH else (b, number)
    at = 0
    while a[at : at + WIDTH] == b[at : at + WIDTH]:
        at += WIDTH
    return (b[: at + WIDTH], SMALLEST) if at < SPLITTER * WIDTH else None


class Skeleton:
    """Splitters, and the trie of all their prefixes; node 0 is the root and parents come first."""

    def __init__(self, sample: list[tuple[bytes, int]], shards: int, limit: int = SKELETON):
        sample = sorted(sample)
        cuts = {len(sample) * i // shards for i in range(1, shards)} - {0}
        found = {_separator(sample[i - 1], sample[i]) for i in cuts} - {None}
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth, self.weight = [-1], [0], [0]
        self.splitters = sorted(s for s in sorted(found, key=lambda s: len(s[0])) if self._insert(s[0], limit))

    def _insert(self, path: bytes, limit: int) -> bool:
        node, at = 0, 0
        while at < len(path) and (node, path[at : at + WIDTH]) in self.child:
            node = self.child[node, path[at : at + WIDTH]]
            at += WIDTH
        if len(self.parent) + (len(path) - at) // WIDTH > limit:
            return False
        for at in range(at, len(path), WIDTH):
            symbol = path[at : at + WIDTH]
            self.child[node, symbol] = len(self.parent)
            self.parent.append(node)
            self.depth.append(self.depth[node] + 1)
            self.weight.append(int.from_bytes(symbol[DIGEST:]))
            node = len(self.parent) - 1
        return True

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


class _Frame:
    """An open node: what its finished children and the conversations that end at it add up to."""

    __slots__ = ("symbol", "sid", "n_convs", "least", "children", "leaves", "saved", "ends", "finished")

    def __init__(self, symbol: bytes, sid: int):
        self.symbol, self.sid = symbol, sid
        self.n_convs = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        # Ids in a skeleton node, a running digest of them elsewhere.
        self.ends = [] if sid >= 0 else None
        self.finished: list[tuple] = []

    def add(self, n_convs: int, least: int):
        self.n_convs += n_convs
        self.least = least if self.least is None else min(self.least, least)


def walk(rows: Iterator[tuple[int, bytes, int]], skeleton: Skeleton) -> Iterator[tuple]:
    """Rows of WALKED from (shard, path, conv_id), sorted: nodes, partial skeleton nodes, blocks of ends."""
    stack: list[_Frame] = []
    current = None

    def block(frame):
        ids, frame.ends = frame.ends, []
        return (ENDS, frame.sid, ids[0], None, None, None, None, None, None, ",".join(map(str, ids)))

    def close():
        frame = stack.pop()
        if frame.sid >= 0:
            if frame.ends:
                yield block(frame)
            yield (
                PARTIAL, frame.sid, frame.least, None, None, frame.n_convs, frame.children, frame.leaves, frame.saved, None
            )
            return
        for node in frame.finished:
            yield (NODE, None, *node[:2], frame.least, *node[2:])
        leaves = frame.leaves if frame.children else 1
        saved = frame.saved + (frame.n_convs - 1) * int.from_bytes(frame.symbol[DIGEST:])
        ends = frame.ends.hexdigest() if frame.ends else NO_ENDS
        node = (frame.least, len(stack), frame.n_convs, frame.children, leaves, saved, ends)
        above = stack[-1]
        above.add(frame.n_convs, frame.least)
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        if above.sid >= 0:
            yield (NODE, above.sid, *node[:2], None, *node[2:])
        else:
            above.finished.append(node)

    for shard, path, conv_id in rows:
        if shard != current:
            while stack:
                yield from close()
            current, stack = shard, [_Frame(b"", 0)]
        depth, at = 1, 0
        while depth < len(stack) and at < len(path) and stack[depth].symbol == path[at : at + WIDTH]:
            depth, at = depth + 1, at + WIDTH
        while len(stack) > depth:
            yield from close()
        for at in range(at, len(path), WIDTH):
            symbol = path[at : at + WIDTH]
            above = stack[-1].sid
            stack.append(_Frame(symbol, skeleton.child.get((above, symbol), -1) if above >= 0 else -1))
        top = stack[-1]
        top.add(1, conv_id)
        if top.sid < 0:
            if top.ends:
                top.ends.update(b",%d" % conv_id)
            else:
                top.ends = hashlib.sha256(b"%d" % conv_id)
        else:
            top.ends.append(conv_id)
            if len(top.ends) == BLOCK:
                yield block(top)
    while stack:
        yield from close()


def _sum_up(skeleton: Skeleton, partial) -> dict[str, list]:
    """Whole skeleton nodes from the sums of their partial rows, children before parents."""
    n = len(skeleton.parent)
    convs, children, leaves, saved = [0] * n, [0] * n, [0] * n, [0] * n
    least: list[int | None] = [None] * n
    for row in partial:
        sid = row["sid"]
        least[sid], convs[sid], children[sid] = row["conv_id"], row["n_convs"], row["n_children"]
        leaves[sid], saved[sid] = row["n_leaves"], row["saved_tokens"]
    for sid in range(n - 1, -1, -1):
        if not children[sid]:
            leaves[sid] = 1
        saved[sid] += (convs[sid] - 1) * skeleton.weight[sid]
        above = skeleton.parent[sid]
        if above >= 0:
            convs[above] += convs[sid]
            children[above] += 1
            leaves[above] += leaves[sid]
            saved[above] += saved[sid]
            least[above] = least[sid] if least[above] is None else min(least[above], least[sid])
    parents = [None if p < 0 else least[p] for p in skeleton.parent]
    return {
        "sid": list(range(n)), "conv_id": least, "depth": skeleton.depth, "parent_conv_id": parents, "n_convs": convs,
        "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
    }


def prefix_trie(turns: DataFrame, shard: int = SHARD, per_shard: int = PER_SHARD, skeleton_nodes: int = SKELETON) -> DataFrame:
    """One row per node of the trie of `turns` (conv_id, turns): see NODES."""
    import pyarrow as pa

    spark = turns.sparkSession
    rows = cut_lineage(
        turns.filter(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long"), F.unhex(F.array_join("turns", "")).alias("path")
        )
    )
    n = rows.count()
    if not n:
        return spark.createDataFrame([], NODES)
    shards = min(n, max(-(-n // shard), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # About shards * per_shard paths, the same ones in every run.
    share = min(1.0, shards * per_shard / n)
    drawn = F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    head = F.expr(f"substring(path, 1, {(SPLITTER + 1) * WIDTH})")
    sample = rows.filter(drawn).select(head.alias("path"), "conv_id").toArrow().to_pylist()
    skeleton = Skeleton([(bytes(r["path"]), r["conv_id"]) for r in sample], shards, skeleton_nodes)
    shared = spark.sparkContext.broadcast(skeleton)

    def deal(batches):
        for batch in batches:
            paths, ids = (c.to_pylist() for c in batch.columns)
            found = [shared.value.shard(p, i) for p, i in zip(paths, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *batch.columns], names=["shard", "path", "conv_id"])

    kinds = [pa.int32(), *[pa.int64()] * 8, pa.string()]
    names = [field.split()[0] for field in WALKED.split(", ")]

    def walk_shards(batches):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        made = []

        def packed():
            columns = zip(*made, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for row in walk(rows, shared.value):
            made.append(row)
            if len(made) == 10_000:
                yield packed()
                made.clear()
        if made:
            yield packed()

    dealt = rows.select("path", "conv_id").mapInArrow(deal, "shard int, path binary, conv_id long")
    walked = cut_lineage(
        dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(walk_shards, WALKED)
    )
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    partial = walked.filter(F.col("kind") == PARTIAL).groupBy("sid").agg(F.min("conv_id").alias("conv_id"), *sums)
    whole = spark.createDataFrame(pa.table(_sum_up(skeleton, partial.toArrow().to_pylist())))

    def hash_blocks(batches):
        current, ends = None, None
        for batch in batches:
            digests = []
            for sid, ids in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if sid != current:
                    if ends:
                        digests.append((current, ends.hexdigest()))
                    current, ends = sid, hashlib.sha256()
                else:
                    ends.update(b",")
                ends.update(ids.as_buffer())
            yield pa.RecordBatch.from_pylist([{"sid": s, "ends_sha256": d} for s, d in digests], schema=hashed)
        if ends:
            yield pa.RecordBatch.from_pylist([{"sid": current, "ends_sha256": ends.hexdigest()}], schema=hashed)

    hashed = pa.schema([("sid", pa.int64()), ("ends_sha256", pa.string())])
    blocks = walked.filter(F.col("kind") == ENDS).select("sid", "conv_id", "ends")
    ended = blocks.repartition("sid").sortWithinPartitions("sid", "conv_id").mapInArrow(hash_blocks, "sid long, ends_sha256 string")
    out = [field.split()[0] for field in NODES.split(", ")]
    skeleton_rows = whole.join(ended, "sid", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    above = whole.select("sid", F.col("conv_id").alias("skeleton_parent"))
    nodes = (
        walked.filter(F.col("kind") == NODE)
        .join(above, "sid", "left")
        .withColumn("parent_conv_id", F.coalesce("skeleton_parent", "parent_conv_id"))
        .withColumnRenamed("ends", "ends_sha256")
    )
    return skeleton_rows.select(*out).unionByName(nodes.select(*out))
