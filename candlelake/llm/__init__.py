"""Operators for training-data pipelines: mixing, sharding, packing, deduplication, search and scoring of documents."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
