"""Operators of a training-data pipeline; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so these need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
