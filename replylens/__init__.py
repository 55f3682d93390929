"""Request/response correlation and latency metrics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from replylens.blueprint import Blueprint, Metric, MetricSource, MetricType, payment_blueprint

__all__ = ["Blueprint", "Metric", "MetricSource", "MetricType", "payment_blueprint"]

# Executors get the few Python helpers with the job, so the package is needed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
