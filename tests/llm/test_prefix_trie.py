"""The trie of conversations against one made of dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from rows import with_clashing_columns

from replylens.llm import prefix_trie
from replylens.llm.queries import op11_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(conversations):
    """{(members' least, depth): row} of {conv_id: [(role, text)]}."""
    members = defaultdict(list)
    for conv_id, turns in sorted(conversations.items()):
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv_id)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    rows = []

    def add(prefix):
        below = [add(c) for c in children[prefix]]
        leaves = sum(b[0] for b in below) or 1
        own = (len(members[prefix]) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        saved = own + sum(b[1] for b in below)
        ends = ",".join(str(c) for c in members[prefix] if len(conversations[c]) == len(prefix))
        parent = members[prefix[:-1]][0] if prefix else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((members[prefix][0], len(prefix), parent, len(members[prefix]), len(below), leaves, saved, sha))
        return leaves, saved

    if conversations:
        add(())
    return sorted(rows, key=lambda r: (r[1], r[0]))


def plain_conversations(rows):
    """{conv_id: [(role, text)]} in order."""
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            found[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(turns)] for c, turns in found.items()}


def plain_heads(conversations):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = conversations.get(c - c % 5, [])[:h] + turns[h:]
    return out


def collected(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[1], r[0]))


def some_conversations(rng, n, longest=9):
    pool = [("u", t) for t in ("", "é", "a", "bb", "a long text " * 9)] + [("", ""), ("assistant", "a")]
    out = {}
    for c in rng.sample(range(10 * n), n):
        out[c] = [rng.choice(pool[: rng.choice([2, 7])]) for _ in range(rng.randrange(longest))]
    return out


def test_walk_and_skeleton_of_any_shards():
    """Whatever the sample and the shards are: same nodes, and what two shards see is in the skeleton."""
    rng = random.Random(11)
    code = lambda t: hashlib.sha256(repr(t).encode()).digest()[:16] + len(t[1].encode()).to_bytes(4)
    for _ in range(150):
        given = some_conversations(rng, rng.randrange(1, 60))
        paths = sorted((b"".join(map(code, turns)), c) for c, turns in given.items())
        skeleton = prefix_trie.Skeleton(rng.sample(paths, rng.randrange(1, len(paths) + 1)), rng.randrange(1, 12), rng.choice([3, 1000]))
        rows = [(skeleton.shard(p, c), p, c) for p, c in paths]
        walked = list(prefix_trie.walk(iter(sorted(rows)), skeleton))
        sums = defaultdict(lambda: dict.fromkeys(("n_convs", "n_children", "n_leaves", "saved_tokens"), 0))
        for _, sid, least, _, _, *four, _ in (w for w in walked if w[0] == prefix_trie.PARTIAL):
            for name, value in zip(("n_convs", "n_children", "n_leaves", "saved_tokens"), four, strict=True):
                sums[sid][name] += value
            sums[sid]["conv_id"] = min((v for v in (least, sums[sid].get("conv_id")) if v is not None), default=None)
        whole = prefix_trie._sum_up(skeleton, [{"sid": s, **row} for s, row in sums.items()])
        least = dict(zip(whole["sid"], whole["conv_id"], strict=True))
        names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
        nodes = list(zip(*(whole[n] for n in names), strict=True))
        for kind, sid, conv_id, depth, parent, *four, _ in walked:
            if kind == prefix_trie.NODE:
                nodes.append((conv_id, depth, parent if sid is None else least[sid], *four))
        assert sorted(nodes, key=lambda r: (r[1], r[0])) == [r[:-1] for r in plain_trie(given)]


@pytest.mark.parametrize("shard", [1, 7, 10_000])
def test_trie_with_hot_conversation(spark, shard):
    """A third of all conversations are one; another third begins with the same turns."""
    hot = [("user", "hello"), ("assistant", "yes")]
    given = {c: hot for c in range(0, 300, 3)} | {c: [*hot, ("user", str(c % 7))] for c in range(1, 300, 3)}
    given |= {c: [("user", str(c))] * (c % 4) for c in range(2, 300, 3)} | {-5: [("user", "x")] * 400, 9999: [("user", "x")] * 400}
    rows = [(c, i, *turn) for c, turns in given.items() for i, turn in enumerate(turns)]
    turns = prefix_trie.conversation_turns(spark.createDataFrame(rows, SCHEMA))
    present = {c: t for c, t in given.items() if t}
    if shard == 10_000:
        assert collected(prefix_trie.prefix_trie(turns)) == plain_trie(present)
    else:
        few = {c: t for c, t in present.items() if c < 100 and len(t) < 100}
        small = turns.filter("conv_id < 100 AND size(turns) < 100")
        assert collected(prefix_trie.prefix_trie(small, shard=shard, per_shard=3)) == plain_trie(few)


def test_blocks_of_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    rows = [(c, 0, "u", "same") for c in range(40)]
    turns = prefix_trie.conversation_turns(spark.createDataFrame(rows, SCHEMA))
    assert collected(prefix_trie.prefix_trie(turns, shard=4)) == plain_trie(plain_conversations(rows))


AWKWARD = [
    (0, None, "user", "first"), (0, 1, "user", "second"), (0, 1, "assistant", "tie"), (0, 0, None, None), (1, 0, "user", "a"),
    (1, 0, "user", "a"), (2, 5, "", ""), (None, 0, "user", "nobody"), (3, None, None, None), (7, 1, "user", "no head"),
    (-7, 1, "user", "below"), (-5, 1, "user", "x"), (11, 1, "é", "long " * 50_000),
]


def test_awkward_rows_and_clashing_columns(spark):
    given = with_clashing_columns(spark.createDataFrame(AWKWARD, SCHEMA))
    for name in ("path", "turns", "symbol", "shard", "h", "head_id", "head", "sid"):
        given = given.selectExpr("*", f"'x' AS {name}")
    turns = prefix_trie.with_shared_heads(prefix_trie.conversation_turns(given))
    plain = plain_heads(plain_conversations(AWKWARD))
    # Python's remainder has the divisor's sign, Spark's the dividend's.
    own = plain_conversations(AWKWARD)
    h = zlib.crc32(b"-7") % 9
    plain[-7] = own[-5][:h] + own[-7][h:]
    assert collected(prefix_trie.prefix_trie(turns)) == plain_trie(plain)


def test_empty_table(spark):
    turns = prefix_trie.conversation_turns(spark.createDataFrame([], SCHEMA))
    assert prefix_trie.prefix_trie(prefix_trie.with_shared_heads(turns)).collect() == []


def test_query_against_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert collected(op11_prefix_trie(spark, sf)) == plain_trie(plain_heads(plain_conversations(rows)))
