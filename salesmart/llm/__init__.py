"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so that no job has to ship it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
