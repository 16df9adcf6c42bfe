"""Subscription-retention analytics expressed as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from staywise.config import EngineConfig

# Functions that run on executors travel with their code: workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["EngineConfig"]
