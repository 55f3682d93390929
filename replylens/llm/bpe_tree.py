r"""Byte-level BPE by tree reduction.

A text is halved until a leaf has at most `LEAF` characters; leaves are encoded directly. Two
neighbours are joined by encoding again only a window around their border, from the last safe cut
before it to the first safe cut after it; the window grows until both are found. A *safe cut* is a
place where the pattern ends one match and starts another whatever stands on either side: no
alternative has a letter, a digit or a punctuation mark followed by an ASCII character of another
class, but for the apostrophe and the white space that matches may start with. So the matches left
and right of the window are those of the whole text, and their tokens stand.

A match that is longer than a leaf (a run of one kind of character) is encoded by halves too. There
the window grows by tokens until the tokens at its two seams are compatible, that is, the two alone
encode to themselves; a sequence of tokens in which all neighbours are compatible is the encoding of
its bytes, so the tokens outside are final.

Decoding joins the bytes of tokens up the same kind of tree.

Another pattern than `CUT_PATTERN` has no known safe cuts: a text longer than a leaf is refused with it.

Defined cases: null text counts as empty and has no tokens; special tokens are ordinary text; rows
are independent, so repeated rows, empty tables and other columns make no difference.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import DataFrame

LEAF = 4096
PIECE = 4096
# Fixed value: the pattern for which SAFE_CUT holds.
CUT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SAFE_CUT = (
    r"(?<=\p{L})(?=[\x00-\x40\x5b-\x60\x7b-\x7f])|(?<=\p{N})(?=[\x00-\x2f\x3a-\x7f])"
    r"|(?<=[!-&(-/:-@\[-`{-~])(?=[A-Za-z0-9 \t\r\n])|(?<=')(?=[ \t\r\n])"
)


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


class TreeBpe:
    """Encoder and decoder for one rank file; `leaf` and `piece` bound what is encoded directly."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, piece: int = PIECE):
        import regex
        import tiktoken

        self.ranks, self.leaf_size, self.piece_size = ranks, leaf, piece
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        encoding = lambda split: tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        self.leaf, self.unsplit = encoding(pattern), encoding(r"[\s\S]+")
        self.matches, self.cut = regex.compile(pattern), regex.compile(SAFE_CUT)
        self.can_cut = pattern == CUT_PATTERN
        self.compatible_pairs: dict[tuple[int, int], bool] = {}

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf_size:
            return self.leaf.encode_ordinary(text)
        if not self.can_cut:
            raise ValueError("no safe cuts are known for this pattern; texts over a leaf need CUT_PATTERN")
        middle = len(text) // 2
        return self.join(text, middle, self.encode(text[:middle]), self.encode(text[middle:]))

    def join(self, text: str, middle: int, left: list[int], right: list[int]) -> list[int]:
        """Tokens of `text` from those of its parts before and after `middle`."""
        start, end = self.cut_before(text, middle), self.cut_after(text, middle)
        if start == middle:
            return left + right
        keep = self.tokens_over(reversed(left), len(text[start:middle].encode()))
        skip = self.tokens_over(right, len(text[middle:end].encode()))
        return left[: len(left) - keep] + self.window(text[start:end]) + right[skip:]

    def cut_before(self, text: str, middle: int) -> int:
        size = 32
        while True:
            start = max(0, middle - size)
            cuts = [m.start() for m in self.cut.finditer(text[start : middle + 1])]
            if cuts or not start:
                return start + cuts[-1] if cuts else 0
            size *= 8

    def cut_after(self, text: str, middle: int) -> int:
        size = 32
        while True:
            # One character more on each side: a cut is seen by its two neighbours.
            found = self.cut.search(text[middle - 1 : middle + size + 1], 1)
            if found or middle + size >= len(text):
                return middle - 1 + found.start() if found else len(text)
            size *= 8

    def tokens_over(self, ids, n_bytes: int) -> int:
        """How many tokens of `ids` make up `n_bytes` bytes; cuts are ends of tokens."""
        count = 0
        for i in ids:
            if n_bytes <= 0:
                break
            n_bytes -= len(self.bytes_of[i])
            count += 1
        return count

    def window(self, text: str) -> list[int]:
        if len(text) <= self.leaf_size:
            return self.leaf.encode_ordinary(text)
        ids: list[int] = []
        for match in self.matches.finditer(text):
            ids += self.encode_match(match.group())
        return ids

    def encode_match(self, text: str) -> list[int]:
        """Tokens of one match of the pattern."""
        if len(text) <= self.piece_size:
            return self.unsplit.encode_ordinary(text)
        middle = len(text) // 2
        left, right = self.encode_match(text[:middle]), self.encode_match(text[middle:])
        width = 2
        while True:
            first, last = max(0, len(left) - width), min(width, len(right))
            # The window holds whole characters.
            while first > 0 and self.bytes_of[left[first]][0] & 0xC0 == 0x80:
                first -= 1
            while last < len(right) and self.bytes_of[right[last]][0] & 0xC0 == 0x80:
                last += 1
            window = b"".join(self.bytes_of[i] for i in left[first:] + right[:last])
            ids = self.unsplit.encode_ordinary(window.decode())
            if (not first or self.compatible(left[first - 1], ids[0])) and (
                last == len(right) or self.compatible(ids[-1], right[last])
            ):
                return left[:first] + ids + right[last:]
            width *= 4

    def compatible(self, first: int, second: int) -> bool:
        pair = (first, second)
        if pair not in self.compatible_pairs:
            self.compatible_pairs[pair] = self.merge(self.bytes_of[first] + self.bytes_of[second]) == [first, second]
        return self.compatible_pairs[pair]

    def merge(self, data: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, leftmost first, until none is a token; for two tokens' bytes."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min(
                (self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
            )
            if rank == 1 << 62:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf_size:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, keep=("doc_id",), with_ids: bool = False, leaf: int = LEAF
) -> DataFrame:
    """The columns `keep`, n_tokens, ids_sha256, decoded_sha256, and `ids` if asked for.

    `rank_file` is read on the driver and sent to the executors: its size is that of a vocabulary.
    """
    with open(rank_file, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = docs.select(*[f"`{c}`" for c in keep]).schema
    schema = f"{_ddl(kept)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    n_kept = len(keep)

    def run(batches):
        import pyarrow as pa

        bpe = TreeBpe(read_ranks(ranks.value), pattern, leaf=leaf)
        names = [str(i) for i in range(max(bpe.bytes_of) + 1)]
        for batch in batches:
            counts, id_digests, text_digests, all_ids = [], [], [], []
            for text in batch.column(n_kept):
                ids = bpe.encode(text.as_py() or "")
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                text_digests.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(pa.array(ids, pa.int32()))
            columns = [batch.column(i) for i in range(n_kept)]
            columns += [pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
            if with_ids:
                sizes = pa.array([0, *counts], pa.int64())
                ends = pa.compute.cumulative_sum(sizes).cast(pa.int32())
                flat = pa.concat_arrays(all_ids) if all_ids else pa.array([], pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, flat))
            yield pa.RecordBatch.from_arrays(columns, names=out_names)

    out_names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    rows = docs.select(*[f"`{c}`" for c in keep], "text")
    return rows.mapInArrow(run, schema + ", ids array<int>" * with_ids)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
