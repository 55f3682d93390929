from datetime import timedelta

import pytest

from replylens import Blueprint, Metric, MetricSource, MetricType, payment_blueprint
from replylens.blueprint import DEFAULT_METRICS, granularity_seconds
from replylens.operators.parse import check_mapping

BASE = dict(
    name=" n ",
    key_field="k",
    request_type_field="t",
    response_type_field="t",
    request_value="a",
    response_value="b",
    timestamp_field="ts",
)


def test_defaults_and_trimming():
    bp = Blueprint(**BASE)
    assert (bp.name, bp.granularity, bp.timeout) == ("n", "1m", timedelta(hours=1))
    assert bp.metrics == DEFAULT_METRICS and bp.bucket_seconds == 60


@pytest.mark.parametrize("missing", list(BASE))
def test_required_text(missing):
    for value in (None, "  "):
        with pytest.raises(ValueError):
            Blueprint(**{**BASE, missing: value})


def test_granularity():
    assert [granularity_seconds(g) for g in ("30s", "1m", "2h", "1d")] == [30, 60, 7200, 86400]
    for bad in ("0m", "m", "1w", "-1s", "1.5h", " 1m"):
        with pytest.raises(ValueError):
            granularity_seconds(bad)


def test_timeout_must_be_positive():
    for bad in (timedelta(0), timedelta(seconds=-1), None):
        with pytest.raises(ValueError):
            Blueprint(**BASE, timeout=bad)


def test_metric_rules():
    assert Metric("m", MetricType.HISTOGRAM).source is MetricSource.LATENCY_MS
    assert Metric("m", "RATE").source is MetricSource.THROUGHPUT_PER_SECOND
    assert Metric("m", MetricType.GAUGE).source is MetricSource.AVG_LATENCY_MS
    assert Metric(" m ", MetricType.COUNTER).name == "m"
    for kind, source in [
        (MetricType.HISTOGRAM, MetricSource.COUNT),
        (MetricType.COUNTER, MetricSource.SUCCESS_RATE),
        (MetricType.RATE, MetricSource.P95_LATENCY_MS),
        (MetricType.GAUGE, MetricSource.COUNT),
    ]:
        with pytest.raises(ValueError):
            Metric("m", kind, source)
    with pytest.raises(ValueError):
        Metric(" ", MetricType.GAUGE)


def test_dimension_names():
    assert Blueprint(**BASE, dimensions=["meta.region"]).dimension_columns == ["meta_region"]
    for bad in (["outcome"], ["a.b", "a_b"]):
        with pytest.raises(ValueError):
            Blueprint(**BASE, dimensions=bad)


def test_payment_blueprint():
    bp = payment_blueprint()
    assert bp.dimensions == ("channel", "response_code") and bp.success_values == {"000"}
    assert len(bp.metrics) == 9


def test_regex_mapping_is_checked():
    check_mapping(r"(\S+) id=(?:x|(\d))", {"a": 1, "b": 2})
    for pattern, groups in [(r"(a)", {"x": 2}), (r"(a)", {"x": 0}), (r"(a)", {}), ("", {"x": 1}), (r"(?:a)", {"x": 1}), (r"(a)", {" ": 1})]:
        with pytest.raises(ValueError):
            check_mapping(pattern, groups)
