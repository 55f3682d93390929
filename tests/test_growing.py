"""Blocks and lines of files that grow while they are read."""

import io
import random

import pytest
from pyspark.sql import functions as F

from replylens.sources import blocks, files

PIECES = [b"<=====>\n", b"a\n", b"  <=======> \r\n", b"<====>\n", b"x<=====>\n", b"\n", b"Field 002: 1\n", b"<=====>", b"yy"]


def plain_blocks(data):
    out, start, at = [], 0, 0
    for line in data.split(b"\n")[:-1]:
        if blocks.SEPARATOR.fullmatch(line + b"\n"):
            out.append((start, data[start:at]))
            start = at + len(line) + 1
        at += len(line) + 1
    return out


def plain_lines(data):
    out, at = [], 0
    for line in data.split(b"\n")[:-1]:
        out.append((at, line))
        at += len(line) + 1
    return out


@pytest.mark.parametrize(("read", "plain"), [(blocks.blocks_ending_in, plain_blocks), (blocks.lines_ending_in, plain_lines)])
def test_whatever_the_sizes_in_between(monkeypatch, read, plain):
    rng = random.Random(6)
    for _ in range(2000):
        data = b"".join(rng.choice(PIECES) for _ in range(rng.randrange(30)))
        monkeypatch.setattr(blocks, "CHUNK", rng.choice([1, 3, 7, 1000]))
        sizes = sorted({0, len(data), *(rng.randrange(len(data) + 1) for _ in range(rng.randrange(6)))})
        got = []
        for start, end in zip(sizes, sizes[1:], strict=False):
            # What is written later must not be seen before.
            got += read(io.BytesIO(data[: rng.choice([end, len(data)])]), start, end)
        assert got == plain(data)


class Counted(io.BytesIO):
    calls = 0

    def read(self, n=-1):
        Counted.calls += 1
        return super().read(n)


def test_a_read_per_chunk_not_per_block():
    data = b"Field 002: 1\n<=====>\n" * 20_000
    for read in (blocks.blocks_in_range, blocks.blocks_ending_in):
        Counted.calls = 0
        assert len(list(read(Counted(data), 0, len(data)))) == 20_000
        assert Counted.calls < 10


def test_an_unfinished_block_is_not_read_again(monkeypatch):
    data = b"text\n" * 100_000
    stream = Counted(data)
    Counted.calls = 0
    for start in range(0, len(data), 50_000):
        assert list(blocks.blocks_ending_in(stream, start, start + 50_000)) == []
    assert Counted.calls < 50


class Measured(io.BytesIO):
    total = 0

    def read(self, n=-1):
        data = super().read(n)
        Measured.total += len(data)
        return data


def test_a_small_range_reads_little_behind_its_end():
    data = b"Field 002: 1\n<=====>\n" * 300_000
    Measured.total, got = 0, []
    for start in range(0, 2_000_000, 50_000):
        got += blocks.blocks_in_range(Measured(data), start, start + 50_000)
    assert got == [b for b in plain_blocks(data[:2_000_100]) if b[0] == 0 or b[0] - 8 < 2_000_000]
    assert Measured.total < 2_500_000
    # A block that goes on far behind its range is still whole.
    data = b"<=====>\n" + b"text\n" * 2_000_000 + b"<=====>\n"
    assert [len(b) for _, b in blocks.blocks_in_range(io.BytesIO(data), 0, 50_000)] == [0, 10_000_000]


def test_a_task_reads_many_small_ranges(spark, tmp_path):
    """Ranges keep their size; tasks follow the bytes, not the ranges."""
    for name in "ab":
        appended(tmp_path / f"{name}.log", b"Field 002: 1\n<=====>\n" * 2_000)
    found = files.read_blocks(spark, str(tmp_path), split_bytes=100)
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted((r.source[-5:], r.offset) for r in found.collect()) == [(f"{n}.log", 21 * i) for n in "ab" for i in range(2_000)]
    given = [("a", 100 << 20), ("b", 950, 50), ("c", 10)]
    planned = blocks.plan_ranges(given, 50_000, 8)
    assert 8 <= len(planned) <= 9 and len(blocks.plan_ranges(given, 50_000, 1)) == 4
    assert [r for p in planned for r in p.parts] == [r for p in blocks.plan_ranges(given, 50_000) for r in p.parts]
    assert max(end - start for p in planned for _, start, end in p.parts) == 50_000
    # Small inputs still have a task for each core, and large ranges a task each.
    assert len(blocks.plan_ranges([("a", 1_000)], 100, 8)) > 4 and len(blocks.plan_ranges([("a", 1 << 30)], 128 << 20, 2)) == 8


def appended(path, text):
    with open(path, "ab") as f:
        f.write(text)


def run(spark, folder, root, unit="blocks"):
    stream = files.stream_growing(spark, str(folder), unit, split_bytes=50)
    writer = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/progress")
    writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema("source string, offset long, value string").parquet(f"{root}/out")
    return sorted((r.source.rsplit("/", 1)[-1], r.offset, r.value) for r in got.collect())


def test_tail_of_growing_rewritten_and_new_files(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path)
    folder.mkdir()
    appended(folder / "a.log", b"one\r\n<=====>\r\ntwo")
    appended(folder / "_hidden", b"no\n<=====>\n")
    assert run(spark, folder, root) == [("a.log", 0, "one\n")]
    # The second block is finished in two steps; between restarts nothing is lost or repeated.
    appended(folder / "a.log", b" and more\n<====")
    assert run(spark, folder, root) == [("a.log", 0, "one\n")]
    appended(folder / "a.log", b"=>\nthree\n<=====>\n\n<=====>\n")
    appended(folder / "b.log", b"x\n<=====>\n" * 20)
    got = run(spark, folder, root)
    assert [g for g in got if g[0] == "a.log"] == [("a.log", 0, "one\n"), ("a.log", 14, "two and more\n"), ("a.log", 35, "three\n")]
    assert sum(g[0] == "b.log" for g in got) == 20
    batch = files.read_blocks(spark, str(folder), split_bytes=50).collect()
    assert sorted((r.source.rsplit("/", 1)[-1], r.offset, r.value) for r in batch) == got
    # Smaller than before: rewritten, read again.
    (folder / "b.log").write_bytes(b"new\n<=====>\n")
    assert ("b.log", 0, "new\n") in run(spark, folder, root)


def test_unfinished_lines_wait(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path)
    folder.mkdir()
    appended(folder / "a.log", b"one\r\n\ntwo, unfin")
    assert [v for *_, v in run(spark, folder, root, "lines")] == ["one", ""]
    for unfinished, expected in ((False, ["one", ""]), (True, ["one", "", "two, unfin"])):
        lines = files.read_lines(spark, str(folder), unfinished=unfinished).select("value", F.monotonically_increasing_id().alias("i"))
        assert [r.value for r in lines.orderBy("i").collect()] == expected
    appended(folder / "a.log", b"ished\n")
    assert [v for *_, v in run(spark, folder, root, "lines")] == ["one", "", "two, unfinished"]
    with pytest.raises(ValueError, match="unit"):
        files.stream_growing(spark, str(folder), "words")
