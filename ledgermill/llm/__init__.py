"""Operators for preparing training data: quality, mixing, sharding, search, near copies, licenses, toxicity."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
