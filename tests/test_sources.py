import io
import random
import re

import pytest
from fixtures import corner_log, sample_log, ten_log
from pyspark.sql import functions as F

from replylens import payment_blueprint
from replylens.operators import parse as P
from replylens.operators.buckets import bucket_metrics
from replylens.operators.correlate import correlate, orphan_responses, unmatched_requests
from replylens.operators.events import matchable
from replylens.operators.legacy import correlate_legacy, waiting_requests
from replylens.sources import blocks, files

BP = payment_blueprint()


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def events_of(blocks_df):
    parsed = P.parse_payment_block(blocks_df.withColumn("event_id", files.arrival()))
    return matchable(P.normalise_payment(parsed), BP)


def cells(pairs):
    rows = bucket_metrics(pairs, BP).collect()
    return {(str(r["bucket_start"]), r["channel"], r["response_code"]): (r["count"], r["min_latency_ms"], r["max_latency_ms"]) for r in rows}


def test_sample_log(spark, tmp_path):
    path = write(tmp_path, "sample.txt", sample_log())
    found = files.read_blocks(spark, path)
    assert found.count() == 6
    assert cells(correlate(events_of(found), BP)) == {
        ("2026-08-09 12:02:00", "UPI", "000"): (1, 186, 186),
        ("2026-08-09 12:02:00", "CARD", "000"): (1, 442, 442),
        ("2026-08-09 12:02:00", "WALLET", "001"): (1, 455, 455),
    }


def test_corner_cases(spark, tmp_path):
    path = write(tmp_path, "corner.txt", corner_log())
    found = files.read_blocks(spark, path, split_bytes=300)
    assert found.count() == 18
    events = events_of(found)
    pairs = correlate(events, BP)
    assert sorted(r[0] for r in pairs.select("latency_ms").collect()) == [0, 50, 100, 150, 150, 200, 500, 5500]
    # Responses without the channel field have an empty channel, which counts as present.
    assert cells(pairs) == {
        ("2026-09-26 18:00:00", "", "000"): (6, 0, 5500),
        ("2026-09-26 18:00:00", "", "001"): (1, 150, 150),
        ("2026-09-26 18:00:00", "", "005"): (1, 500, 500),
    }
    assert unmatched_requests(events, pairs).count() == 1 and orphan_responses(events, pairs).count() == 1
    named = correlate(events, BP, empty_as_null=True)
    assert {r[0] for r in named.select("channel").collect()} == {"UPI", "CARD", "WALLET"}


def test_ten_pairs(spark, tmp_path):
    path = write(tmp_path, "CIDC_001.txt", ten_log())
    got = correlate(events_of(files.read_blocks(spark, path)), BP)
    latencies = {}
    for r in got.collect():
        latencies.setdefault((r["channel"], r["response_code"]), []).append(r["latency_ms"])
    assert {k: sorted(v) for k, v in latencies.items()} == {
        ("CARD", "000"): [350, 412],
        ("CARD", "003"): [823],
        ("MOBILE_WALLET", "000"): [89, 467],
        ("NET_BANKING", "000"): [105, 245],
        ("UPI", "000"): [145, 578, 734],
    }


def legacy_events(blocks_df):
    parsed = P.parse_payment_block(blocks_df)
    role = F.when(F.col("message_id") == "1200", "request").when(F.col("message_id") == "1210", "response")
    return parsed.select(
        files.arrival().alias("event_id"), F.concat_ws("|", "pan", "stan").alias("correlation_key"), role.alias("role"),
        F.col("ts").alias("event_ts"), "stan", "pan", "channel", "response_code",
    ).filter("role IS NOT NULL")


def test_corner_cases_in_arrival_order(spark, tmp_path):
    path = write(tmp_path, "corner.txt", corner_log())
    events = legacy_events(files.read_blocks(spark, path))
    rows = {r["stan"] + r["pan"][:1]: r for r in correlate_legacy(events).collect()}
    assert len(rows) == 7 and "2222221" not in rows  # the response came first: no match
    assert rows["8888883"]["tat_millis"] == 0 and not rows["8888883"]["is_valid"]
    assert rows["1111111"]["channel"] == "UPI" and rows["1111111"]["is_valid"]
    assert {r["stan"] for r in waiting_requests(events).collect()} == {"555555", "222222"}


def test_legacy_separator(spark, tmp_path):
    path = write(tmp_path, "CIDC_001.txt", ten_log() + "Pid: 7 tail without a mark")
    write(tmp_path, "other.txt", "ignored")
    values = [r["value"] for r in files.read_blocks_legacy(spark, str(tmp_path), files.LEGACY_GLOB).collect()]
    assert len(values) == 21 and any("tail without a mark" in v for v in values)
    # The long separator is not the literal one: the whole file is one record.
    path = write(tmp_path, "CIDC_002.txt", sample_log())
    assert files.read_blocks_legacy(spark, path).count() == 1


@pytest.mark.parametrize("split", [7, 64, 1000, 1 << 20])
def test_blocks_do_not_depend_on_splits(spark, tmp_path, split):
    text = corner_log().replace("\n", "\r\n") + "unfinished\n"
    path = write(tmp_path, "a.txt", text)
    whole = {(r["source"].split(":")[-1], r["value"]) for r in files.read_blocks_whole_files(spark, path).collect()}
    got = files.read_blocks(spark, path, split_bytes=split).collect()
    assert {(r["source"].split(":")[-1], r["value"]) for r in got} == whole and len(got) == 18


def reference_blocks(data):
    out, text, start, at = [], b"", 0, 0
    for line in data.split(b"\n")[:-1]:
        at += len(line) + 1
        if re.fullmatch(rb"\s*<={5,}>\s*", line):
            out.append((start, text))
            text, start = b"", at
        else:
            text += line + b"\n"
    return out


def test_ranges_own_each_block_once(monkeypatch):
    rng = random.Random(4)
    pieces = [b"<=====>\n", b"a\n", b"  <=======> \r\n", b"<====>\n", b"x<=====>\n", b"\n", b"Field 002: 1\n", b"<=====>", b"yy"]
    for _ in range(1500):
        data = b"".join(rng.choice(pieces) for _ in range(rng.randrange(30)))
        monkeypatch.setattr(blocks, "CHUNK", rng.choice([1, 3, 7, 1000]))
        size = rng.choice([1, 2, 5, 13, 40, 10000])
        got = []
        for start in range(0, len(data), size):
            got += blocks.blocks_in_range(io.BytesIO(data), start, min(start + size, len(data)))
        assert sorted(got) == reference_blocks(data)


def test_memory_of_the_separator_scan_is_bounded(monkeypatch):
    """A file without separators, and a line longer than any separator."""
    monkeypatch.setattr(blocks, "CHUNK", 1000)
    monkeypatch.setattr(blocks, "LINE", 5000)

    class Watched(io.BytesIO):
        most = 0

        def read(self, n):
            Watched.most = max(Watched.most, n)
            return super().read(n)

    assert list(blocks.blocks_in_range(Watched(b"text\n" * 50_000), 0, 250_000)) == []
    assert Watched.most == 1000
    data = b"x" * 60_000 + b"<=====>\n"
    got = list(blocks.blocks_in_range(io.BytesIO(b"y\n<=====>\n" + data + b"<=====>\nrest"), 0, 10))
    assert got == [(0, b"y\n"), (10, data)]


def test_nested_folders(spark, tmp_path, caplog):
    (tmp_path / "day=1" / "h=1").mkdir(parents=True)
    write(tmp_path / "day=1" / "h=1", "a.log", "one\n")
    assert files.list_files(spark, [str(tmp_path)]) == [] and "day=1" in caplog.text
    assert len(files.list_files(spark, [str(tmp_path)], "*.log", recursive=True)) == 1


def test_small_files_share_a_partition():
    plan = blocks.plan_ranges([("a", 10), ("b", 10), ("c", 100), ("d", 0)], 50)
    assert [list(r.parts) for r in plan] == [
        [("a", 0, 10), ("b", 0, 10)],
        [("c", 0, 50)],
        [("c", 50, 100)],
    ]


def test_lines(spark, tmp_path, caplog):
    path = write(tmp_path, "a.log", "one\r\n\ntwo\rhalf\n")
    got = [r["value"] for r in files.read_lines(spark, [path, str(tmp_path / "missing.log")]).collect()]
    assert got == ["one", "", "two\rhalf"]
    assert "missing.log" in caplog.text
    assert files.read_lines(spark, str(tmp_path / "nothing")).count() == 0
    assert files.read_blocks(spark, str(tmp_path / "nothing")).count() == 0
