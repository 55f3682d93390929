"""Stages on tables whose columns have the names that the code uses itself."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import documents

import replylens.llm
from corpus_pipeline import STAGES

SF = "/root/testdata/sf0.001"
QUOTED = re.compile(r"""["']([A-Za-z_][A-Za-z0-9_]*)["']|(?<![A-Za-z_])([a-z_]+)(?==)""")


def technical_names():
    """Every quoted or keyword name in the modules, so also every column name that they use."""
    found = set()
    for path in Path(replylens.llm.__file__).parent.glob("*.py"):
        found |= {a or b for a, b in QUOTED.findall(path.read_text())}
    return sorted({n.lower() for n in found} - {"doc_id", "text", "lang", "source", "n_chars"})


@pytest.mark.parametrize("number", range(4))
def test_stage_with_every_technical_name(spark, number):
    texts = [f"word{i % 7} " * 12 + "and a few more words that differ " + str(i % 9) for i in range(60)]
    plain = documents(spark, texts)
    names = technical_names()
    assert len(names) > 300 and {"_id", "row", "key", "any_kept", "times"} <= {*names, "_id"}
    extra = plain.select("*", *[F.lit(f"kept {i}").alias(n) for i, n in enumerate([*names, "_id", "_key", "_n", "_kept", "_text_key", "_mix_of"]) if n not in ("_id", "_key") or i >= len(names)])
    stage = STAGES[number][1]
    got = stage(spark, extra, SF)
    assert got.columns == extra.columns
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in stage(spark, plain, SF).collect())
    assert all(r["times"] == f"kept {names.index('times')}" for r in rows)
