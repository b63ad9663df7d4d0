"""Operators for preparing training text; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
