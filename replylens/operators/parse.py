"""Text records -> flat columns, as bulk column expressions."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replylens.functions import hash_key, once

# The lines and fields of a payment message block.
BLOCK_PID = r"(?m)^.*?Pid:[^\S\n]*(\d+)"
BLOCK_TIME = r"(?m)^.*?(?:Received|Sent) At:[^\S\n]*(\S.*)$"
BLOCK_MESSAGE_ID = r"(?m)^.*?MessageId:[^\S\n]*(\d+)"
BLOCK_FIELD = r"(?m)^.*?Field[^\S\n]+(\d{3}):[^\S\n]*(.*)$"
BLOCK_TIME_FORMAT = "MM/dd/yyyy HH:mm:ss.SSS"
PAN, STAN, RESPONSE_CODE, CHANNEL = "002", "011", "039", "123"
LOCAL_TIME, LOCAL_DATE = "012", "017"
LOCAL_FORMAT = "yyyyMMddHHmmss"
EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def not_blank(df: DataFrame, value: str = "value") -> DataFrame:
    """Drop records without any visible character (`trim` would keep line breaks)."""
    return df.filter(F.col(value).rlike(r"\S"))


# -- JSON ----------------------------------------------------------------------------------


def _splits(name: str) -> list:
    """All ways to read a dotted name as nested keys, most nested first: a key may hold dots."""
    parts = name.split(".")
    found = [[parts[0]]]
    for part in parts[1:]:
        found = [f + [part] for f in found] + [[*f[:-1], f"{f[-1]}.{part}"] for f in found]
    return found


def _put(tree: dict, keys: list) -> None:
    for key in keys[:-1]:
        tree = tree.setdefault(key, {})
    tree[keys[-1]] = None


def _fits(tree: dict, keys: list) -> bool:
    """Whether a path of keys fits: no key is both a value and an object."""
    for key in keys[:-1]:
        if key not in tree:
            return True
        tree = tree[key]
        if tree is None:
            return False
    return tree.get(keys[-1]) is None


def _shape(tree: dict) -> T.StructType:
    return T.StructType([T.StructField(k, T.StringType() if t is None else _shape(t)) for k, t in tree.items()])


def _json_path(parts: list) -> str:
    return "$" + "".join(f"['{p}']" for p in parts)


def _not_object(text: Column, value: Column, keys: list) -> Column:
    """An object is no value, its own entries are. Only text that looks like an object is parsed
    again to tell it from a string."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(value), _json_path(keys), "variant"))
    return F.when(text.startswith("{"), F.when(~kind.startswith("OBJECT"), text)).otherwise(text)


def parse_json_fields(df: DataFrame, fields: list, value: str = "value") -> DataFrame:
    """Add one STRING column per named field; malformed records get `is_object` false.

    Only the named fields are extracted, in one parse: nested keys are written with dots, and the
    schema has them both as nested objects and as keys with dots. A second parse is only needed if
    one named field is the parent of another. A fraction may lose trailing zeros (`parse_json` keeps them).
    """
    text = F.col(value)
    trees, places = [], []
    for i, name in enumerate(fields):
        for j, keys in enumerate(_splits(name)):
            number = next((n for n, tree in enumerate(trees) if _fits(tree, keys)), len(trees))
            if number == len(trees):
                trees.append({})
            _put(trees[number], keys)
            places.append((f"_{i}_{j}", name, keys, number))
    # Inside brackets, text after the object makes the whole array malformed.
    boxed = F.concat(F.lit("["), text, F.lit("]"))
    options = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}
    parsed = [F.from_json(boxed, T.ArrayType(_shape(tree)), options) for tree in trees or [{"_": None}]]
    found = once(df, [p.alias(f"_json_{n}") for n, p in enumerate(parsed)])

    def at(keys, number):
        node = F.get(f"_json_{number}", F.lit(0))
        for key in keys:
            node = node.getField(key)
        return node

    is_object = F.coalesce((F.size("_json_0") == 1) & F.get("_json_0", F.lit(0)).isNotNull(), F.lit(False))
    found = once(found, [is_object.alias("is_object"), *[at(keys, n).alias(c) for c, _, keys, n in places]])

    def chosen(name):
        parts = [_not_object(F.col(c), text, keys) for c, f, keys, _ in places if f == name]
        return F.when(F.col("is_object"), F.coalesce(*parts))

    technical = [f"_json_{n}" for n in range(len(parsed))] + [c for c, *_ in places]
    return once(found, [chosen(f).alias(f) for f in fields]).drop(*technical)


class _Number(str):
    """A JSON number as written."""


def _json_text(value) -> str:
    if isinstance(value, _Number):
        return str(value)
    if isinstance(value, list):
        return "[" + ",".join(_json_text(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_json_text(v)}" for k, v in value.items()) + "}"
    return json.dumps(value, ensure_ascii=False)


def _flatten(record: dict) -> dict:
    flat, todo = {}, [("", record)]
    while todo:
        prefix, node = todo.pop()
        for key, value in node.items():
            name = f"{prefix}{key}"
            if isinstance(value, dict):
                todo.append((name + ".", value))
            elif isinstance(value, str):
                flat[name] = str(value)
            elif value is not None:
                flat[name] = _json_text(value)
    return flat


def _reject(name):
    raise ValueError(name)


def _parse_one(text):
    if text is None:
        return None
    try:
        record = json.loads(text, parse_float=_Number, parse_int=_Number, parse_constant=_reject)
    except (ValueError, RecursionError):
        return None
    if not isinstance(record, dict):
        return None
    flat = _flatten(record)
    if "\\u" in text:
        # Half of a surrogate pair is no character; the JVM puts a question mark too.
        clean = lambda s: s.encode("utf-8", "replace").decode()
        flat = {clean(k): clean(v) for k, v in flat.items()}
    return flat


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def _flat_map(texts: pd.Series) -> pd.Series:
    return texts.map(_parse_one)


def parse_json(df: DataFrame, value: str = "value", name: str = "fields") -> DataFrame:
    """Add the whole record as a flat MAP (any depth, numbers as written); NULL if malformed.

    For records whose field names are not known beforehand and whose numbers must keep their text.
    `flatten_json` does without Python; known fields are cheapest to take with `parse_json_fields`.
    """
    return df.withColumn(name, _flat_map(F.col(value)))


def flatten_json(df: DataFrame, value: str = "value", name: str = "fields") -> DataFrame:
    """Add the whole record as a flat MAP (any depth); NULL if malformed. All in the JVM, by VARIANT values.

    As `parse_json`, but numbers lose their text: zeros at the end of a fraction go (`1.50` is `1.5`), and exponents
    and more than 38 digits become doubles (`1e5` is `100000.0`). A name twice in one object is malformed. If a name
    with dots and a nested one are the same, the most nested counts, and of equally nested ones the largest text.
    """
    options = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}
    # Inside brackets, text after the object makes the whole array malformed.
    boxed = F.from_json(F.concat(F.lit("["), F.col(value), F.lit("]")), "array<variant>", options)
    found = once(df, [boxed.alias("_variants")])
    record = F.col("_record")
    found = once(found, [F.when(F.size("_variants") == 1, F.get("_variants", F.lit(0))).alias("_record")]).drop("_variants")
    members = lambda variant: F.map_entries(F.try_variant_get(variant, "$", "map<string,variant>"))
    entry = lambda key, variant, depth: F.struct(key.alias("key"), variant.alias("value"), depth.alias("depth"))

    def opened(e):
        inner = F.transform(members(e["value"]), lambda m: entry(F.concat(e["key"], F.lit("."), m["key"]), m["value"], e["depth"] + 1))
        return F.coalesce(inner, F.array(e))

    # One step opens all objects of a level; a schema names each level of objects at least once.
    steps = F.regexp_count(F.schema_of_variant(record), F.lit("OBJECT<")) - 1
    top = F.transform(members(record), lambda m: entry(m["key"], m["value"], F.lit(1)))
    none = F.slice(F.array(F.lit(0)), 1, 0)
    levels = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(none)
    flat = F.reduce(levels, top, lambda entries, _: F.flatten(F.transform(entries, opened)))
    texts = F.transform(flat, lambda e: entry(e["key"], e["value"].cast("string"), e["depth"]))
    found = once(found, [F.filter(texts, lambda e: e["value"].isNotNull()).alias("_entries")])
    entries, keys = F.col("_entries"), F.array_distinct("_entries.key")

    def most_nested(key):
        same = F.filter(entries, lambda e: e["key"] == key)
        return F.array_max(F.transform(same, lambda e: F.struct(e["depth"], e["value"].alias("value"))))["value"]

    pairs = F.transform(entries, lambda e: F.struct(e["key"], e["value"]))
    chosen = F.transform(keys, lambda key: F.struct(key.alias("key"), most_nested(key).alias("value")))
    flat_map = F.map_from_entries(F.when(F.size(keys) == F.size(entries), pairs).otherwise(chosen))
    return once(found.drop(name), [flat_map.alias(name)]).drop("_record", "_entries")


def fields_as_columns(df: DataFrame, fields: list, name: str = "fields") -> DataFrame:
    keep = [F.col(c) for c in df.columns if c != name]
    return df.select(*keep, *[F.element_at(name, F.lit(f)).alias(f) for f in fields])


# -- delimited text ------------------------------------------------------------------------


def check_mapping(pattern: str, groups: dict) -> None:
    if not pattern or not groups:
        raise ValueError("a pattern and a field mapping are required")
    # A non-capturing open parenthesis starts with `(?` unless it names a group.
    opened = len(re.findall(r"(?<!\\)\((?!\?)|(?<!\\)\(\?<[A-Za-z]", re.sub(r"\\\\|\[[^\]]*\]", "", pattern)))
    for name, group in groups.items():
        if not name or not name.strip() or not isinstance(group, int) or not 1 <= group <= opened:
            raise ValueError(f"invalid capture group for field {name!r}")


def parse_regex(
    df: DataFrame, pattern: str, groups: dict, value: str = "value", may_be_empty: tuple = ()
) -> DataFrame:
    """Keep records in which the pattern is found and add one column per mapped group.

    A group that took no part is absent (NULL). The regex functions return '' for it, so a
    field that may be captured as an empty string is to be listed in `may_be_empty`.
    """
    check_mapping(pattern, groups)
    text = F.col(value)

    def captured(name, group):
        found = F.regexp_extract(text, pattern, group)
        return found if name in may_be_empty else F.when(found != "", found)

    hits = df.filter((text != "") & text.rlike(pattern))
    return once(hits, [captured(n, g).alias(n) for n, g in groups.items()])


# -- payment message blocks ----------------------------------------------------------------


def _last(block: Column, pattern: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(block, F.lit(pattern), F.lit(1)), F.lit(-1))


def parse_payment_block(df: DataFrame, value: str = "value", all_fields: bool = False) -> DataFrame:
    """Add pid, ts, message_id and the payment fields of a block; the later line wins.

    A missing field reads as ''. `all_fields` adds the MAP of every `Field nnn` line.
    """
    block = F.col(value)
    entries = F.arrays_zip(
        F.regexp_extract_all(block, F.lit(BLOCK_FIELD), F.lit(1)).alias("k"),
        F.regexp_extract_all(block, F.lit(BLOCK_FIELD), F.lit(2)).alias("v"),
    )
    parsed = df.withColumn("_entries", entries)

    def numbered(number):
        same = F.filter("_entries", lambda e: e["k"] == number)
        return F.try_element_at(same, F.lit(-1))["v"]

    def payment_field(number):
        lit = F.lit(number)
        return F.coalesce(F.regexp_replace(numbered(lit), EDGE_BLANKS, ""), F.lit(""))

    columns = [
        _last(block, BLOCK_PID).try_cast("int").alias("pid"),
        F.try_to_timestamp(
            F.regexp_replace(_last(block, BLOCK_TIME), EDGE_BLANKS, ""), F.lit(BLOCK_TIME_FORMAT)
        ).alias("ts"),
        _last(block, BLOCK_MESSAGE_ID).alias("message_id"),
        payment_field(PAN).alias("pan"),
        payment_field(STAN).alias("stan"),
        payment_field(CHANNEL).alias("channel"),
        payment_field(RESPONSE_CODE).alias("response_code"),
        payment_field(LOCAL_TIME).alias("local_time"),
        payment_field(LOCAL_DATE).alias("local_date"),
    ]
    if all_fields:
        names = F.array_distinct(F.transform("_entries", lambda e: e["k"]))
        cleaned = F.transform(
            names,
            lambda k: F.struct(k.alias("key"), F.regexp_replace(numbered(k), EDGE_BLANKS, "").alias("value")),
        )
        columns.append(F.map_from_entries(cleaned).alias("fields"))
    return once(parsed, columns).drop("_entries")


def transaction_time() -> Column:
    """Field 017 followed by field 012 as yyyyMMddHHmmss, else the time of the message."""
    local = F.try_to_timestamp(F.concat("local_date", "local_time"), F.lit(LOCAL_FORMAT))
    return F.coalesce(F.when(F.col("local_time") != "", local), F.col("ts"))


def payment_reject_reason() -> Column:
    """Why a block gives no event; NULL if it gives one. A bad time is rejected, never replaced
    by the current time."""
    return (
        F.when(F.col("message_id").isNull() | ~F.col("message_id").isin("1200", "1210"), "unsupported message id")
        .when(F.col("ts").isNull(), "invalid timestamp")
        .when((F.col("pan") == "") | (F.col("stan") == ""), "missing core field")
    )


def normalise_payment(blocks: DataFrame) -> DataFrame:
    """Parsed blocks -> flat records of the payment blueprint. The card number is only hashed."""
    keep = [F.col(c) for c in ("event_id", "source", "offset") if c in blocks.columns]
    return blocks.filter(payment_reject_reason().isNull()).select(
        *keep,
        hash_key(F.col("pan"), F.col("stan")).alias("correlation_key"),
        F.when(F.col("message_id") == "1200", "REQ").otherwise("RESP").alias("direction"),
        F.col("ts").alias("timestamp"),
        "message_id",
        "channel",
        "response_code",
    )
