"""Operators for preparing training text at scale, and their queries."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value: executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
