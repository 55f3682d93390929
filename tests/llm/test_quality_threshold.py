"""The cut between good and poor labels, wherever the weights lie."""

import math

import pytest

from replylens.llm import quality_resample


@pytest.mark.parametrize(
    "good,poor,low,high",
    [
        ([-900, -300, 10], [-900, -300, 10], -math.inf, -math.inf),
        ([-300, -290, -250], [-1000, -900, -800], -800, -300),
        ([900, 5000], [300, 310, 400], 400, 900),
        ([3, 4], [-3, -4], -3, 3),
    ],
)
def test_threshold(spark, good, poor, low, high):
    weights = [(w, True) for w in good] + [(w, False) for w in poor]
    scored = spark.createDataFrame([(i, float(w)) for i, (w, _) in enumerate(weights)], "doc_id long, log_weight double")
    sample = spark.createDataFrame([(i, g, False) for i, (_, g) in enumerate(weights)], "_label_id long, good boolean, fits boolean")
    cut = quality_resample.threshold(scored, sample)
    assert cut == low if math.isinf(low) else low < cut <= high


def test_long_texts_stay_where_labels_say_nothing(spark):
    texts = ["common words here " * 200] * 40 + ["strange " * 3000 + f"{i}" for i in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i // 2 % 2) for i in range(40)], "doc_id long, quality long")
    rows = quality_resample.resample(docs, labels).collect()
    assert min(r.log_weight for r in rows) < -200 and all(r.taken for r in rows)
