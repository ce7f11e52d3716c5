"""Operators for building training data. Their functions travel to executors by value."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
