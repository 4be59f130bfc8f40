"""Operators that prepare text for training: extraction, scans, duplicates, mixing, token files."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
