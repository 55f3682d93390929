from pyspark.sql import functions as F

from replylens.functions import strict_instant
from replylens.operators import parse as P


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


RECORD = '{"request_id":"r-1","meta":{"region":"west","deep":{"x":1.50}},"count":3,"none":null,"list":[1, {"a":2.0}],"yes":true}'


def test_json_map(spark):
    row = P.parse_json(texts(spark, RECORD)).first()["fields"]
    assert row == {
        "request_id": "r-1",
        "meta.region": "west",
        "meta.deep.x": "1.50",
        "count": "3",
        "list": '[1,{"a":2.0}]',
        "yes": "true",
    }


def test_json_fields(spark):
    names = ["request_id", "meta.region", "meta.deep", "count", "none", "list", "yes", "text", "a.b"]
    record = RECORD[:-1] + ',"text":"{not an object}","a.b":"flat"}'
    row = P.parse_json_fields(texts(spark, record), names).first()
    assert [row[n] for n in names] == ["r-1", "west", None, "3", None, '[1,{"a":2.0}]', "true", "{not an object}", "flat"]
    assert row["is_object"]


def test_json_names_with_dots(spark):
    record = '{"a.b":{"c":"1"},"x":{"y.z":"2"},"s":"{\\"t\\":3}"}'
    row = P.parse_json_fields(texts(spark, record), ["a.b.c", "x.y.z", "s.t", "s", "a.b"]).first()
    assert [row[n] for n in ("a.b.c", "x.y.z", "s.t", "s", "a.b")] == ["1", "2", None, '{"t":3}', None]


def test_malformed_json(spark):
    bad = ["{invalid json}", "[1]", '"x"', '{"a":1} trailing', '{"a":1},{"a":2}', '{"a":1', "7"]
    assert not any(r["is_object"] for r in P.parse_json_fields(texts(spark, *bad), ["a"]).collect())
    assert all(r["a"] is None for r in P.parse_json_fields(texts(spark, *bad), ["a"]).collect())
    assert all(r["fields"] is None for r in P.parse_json(texts(spark, *bad)).collect())


def test_blank_records(spark):
    assert [r[0] for r in P.not_blank(texts(spark, "", "  \t", "\n\n", " x ")).collect()] == [" x "]


def test_regex(spark):
    groups = {"timestamp": 1, "request_id": 2, "direction": 3}
    lines = texts(spark, "2026-10-01T10:00:00Z id=req-2 type=begin", "unrelated log line", "")
    rows = P.parse_regex(lines, r"(\S+) id=(\S+) type=(\S+)", groups).drop("value").collect()
    assert [tuple(r) for r in rows] == [("2026-10-01T10:00:00Z", "req-2", "begin")]


def test_regex_optional_and_empty_groups(spark):
    lines = texts(spark, "a=1", "a=1 b=", "a=1 b=2")
    rows = P.parse_regex(lines, r"a=(\d)(?: b=(\d*))?", {"a": 1, "b": 2}).collect()
    assert [r["b"] for r in rows] == [None, None, "2"]
    rows = P.parse_regex(lines, r"a=(\d)(?: b=(\d*))?", {"a": 1, "b": 2}, may_be_empty=("b",)).collect()
    assert [r["b"] for r in rows] == ["", "", "2"]


BLOCK = (
    "Pid: 1 Received At: 10/01/2026 10:00:00.000\r\nMessageId: 1200\nField 002: 4111111111111111\n"
    "Field 011:   123456  \nField 123: OLD\n  note Field 123: ATM\nField 125: account-reference\n"
    "Field 127: Field 039: cardholder-name\n"
)


def test_block_fields(spark):
    row = P.parse_payment_block(texts(spark, BLOCK), all_fields=True).first()
    assert (row["pid"], row["message_id"], row["stan"], row["channel"], row["response_code"]) == (1, "1200", "123456", "ATM", "")
    assert str(row["ts"]) == "2026-10-01 10:00:00"
    assert row["fields"]["127"] == "Field 039: cardholder-name" and "039" not in row["fields"]


def test_card_number_is_never_exposed(spark):
    row = P.normalise_payment(P.parse_payment_block(texts(spark, BLOCK))).first().asDict()
    assert row["direction"] == "REQ" and row["channel"] == "ATM" and len(row["correlation_key"]) == 64
    assert not any("4111111111111111" in str(v) or "cardholder" in str(v) for v in row.values())


def test_rejected_blocks(spark):
    blocks = texts(
        spark,
        BLOCK.replace("1200", "1804"),
        BLOCK.replace("10/01/2026", "02/30/2026"),
        BLOCK.replace("Field 011", "Field 012"),
        BLOCK,
    )
    reasons = [r[0] for r in P.parse_payment_block(blocks).select(P.payment_reject_reason()).collect()]
    assert reasons == ["unsupported message id", "invalid timestamp", "missing core field", None]


def test_instants(spark):
    good = ["2026-10-01T10:00:00Z", "2026-10-01T10:00:00.125Z", "2026-10-01t10:00:00.123456789z"]
    bad = ["2026-10-01 10:00:00", "2026-10-01T10:00:00+01:00", "2026-02-30T10:00:00Z", "2026-10-01", "", "x"]
    got = [r[0] for r in texts(spark, *good, *bad).select(strict_instant(F.col("value"))).collect()]
    assert [str(g) for g in got[:3]] == ["2026-10-01 10:00:00", "2026-10-01 10:00:00.125000", "2026-10-01 10:00:00.123456"]
    assert got[3:] == [None] * len(bad)


BAD_AND_ODD = [
    '{"a":"\\ud800"}', '{"a":"x\\udc00y"}', '{"a":"\\ud83d\\ude00"}', '{"a":NaN}', '{"a":Infinity}', '{"a":-Infinity}', '{"a":1.5}',
    '{"a":1,"a":2}', '{"a":{"b":"n"},"a.b":"d"}', '{"a":"{x"}', '{"a":"{}"}', '{"a":{}}', '{"a":[1,{"c":2.0}]}', '{"a":null}', '{"a":true}',
    '{"a":1} trailing', '{"a":1}{"a":2}', "[1]", "null", "1", '"a"', "", " ", '{"a"', "{a:1}", "{'a':1}", '{"a":01}', '{"a":1,}', "{}", '{"b":1}',
    '{"a":' + "[" * 50 + "]" * 50 + "}", None,
]


def test_both_parsers_agree_on_bad_and_odd_records(spark):
    """Neither ends the job, and both take and refuse the same records."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(BAD_AND_ODD)], "i int, value string")
    named = {r["i"]: r for r in P.parse_json_fields(df, ["a", "a.b"]).collect()}
    whole = {r["i"]: r["fields"] for r in P.parse_json(df).collect()}
    for i, text in enumerate(BAD_AND_ODD):
        assert named[i]["is_object"] == (whole[i] is not None), text
        flat = whole[i] or {}
        assert (named[i]["a"], named[i]["a.b"]) == (flat.get("a"), flat.get("a.b")), text


def test_block_lines_take_their_first_match(spark):
    block = "Pid: 1 Pid: 2\nMessageId: 1200 MessageId: 1210\n"
    row = P.parse_payment_block(spark.createDataFrame([(block,)], "value string")).first()
    assert (row["pid"], row["message_id"]) == (1, "1200")


DEEP = '{"k":' * 40 + '{"end":[{"x":1},{"y":{"z":"t"}}]}' + "}" * 40


def test_flatten_json_equals_parse_json(spark):
    """Malformed, odd and deep records; numbers whose text differs and names twice in an object are below."""
    rows = [t for t in BAD_AND_ODD if t is None or ("2.0" not in t and t.count('"a":') < 2)]
    rows += [DEEP, '{"a":{},"b":{"c":{}}}', '{"a.b.c":"1","a":{"b":{"c":"3"},"b.c":"2"}}', '{"s":"OBJECT<","a b":{"":"e"}}', '{"l":[{"a":1},"x",null]}']
    df = spark.createDataFrame(list(enumerate(rows)), "i int, value string")
    got = {r["i"]: r["fields"] for r in P.flatten_json(df).collect()}
    want = {r["i"]: r["fields"] for r in P.parse_json(df).collect()}
    assert P.flatten_json(df).columns == ["i", "value", "fields"]
    for i, text in enumerate(rows):
        assert got[i] == want[i], text
    assert got[rows.index(DEEP)] == {"k." * 40 + "end": '[{"x":1},{"y":{"z":"t"}}]'}


def test_flatten_json_numbers_and_repeated_names(spark):
    row = P.flatten_json(texts(spark, '{"a":1.50,"b":1e5,"c":{"d":[2.0]},"e":12345678901234567890}')).first()["fields"]
    assert row == {"a": "1.5", "b": "100000.0", "c.d": "[2]", "e": "12345678901234567890"}
    assert P.flatten_json(texts(spark, '{"a":1,"a":2}')).first()["fields"] is None


def test_flatten_json_stays_in_the_jvm(spark):
    plan = P.flatten_json(texts(spark, RECORD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
