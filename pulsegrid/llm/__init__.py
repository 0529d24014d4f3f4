"""Operators for preparing training data: near copies, packing, mixing, tokens, archives, filters."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value: workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
