"""Spark-native preparation of multilingual text corpora."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions travel to Python workers by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
