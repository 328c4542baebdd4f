"""Spark-native ingestion and analytics for exchange-rate and stock-bar feeds."""

import sys

from pyspark import cloudpickle

# Tasks carry the code they run, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
