"""Spark-native operators for capture-media catalogues, frames and job history."""

import sys

from pyspark import cloudpickle

# tasks carry this package's functions with them, so executors need no installation of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
