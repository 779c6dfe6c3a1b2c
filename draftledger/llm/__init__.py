"""Operators for preparing training text at scale: deduplication, extraction, scans, mixing."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
