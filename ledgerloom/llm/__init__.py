"""Operators for preparing training data."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors with their code, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
