"""Operators for preparing training data: filtering, deduplication, mixing, scoring and token files."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
