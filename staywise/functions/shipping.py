"""Objects of this package as broadcasts that workers can read without having the package."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def shipped(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A function for executors that returns ``value``; call it once per task.

    Broadcasts name classes by their module; packed like this, their code travels along.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(packed.value)
