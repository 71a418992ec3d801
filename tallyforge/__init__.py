"""Spark-native tabular features, data contracts, profiling, drift and model preparation."""

import sys

from pyspark import cloudpickle

# The few vectorised helpers travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
