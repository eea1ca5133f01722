"""Operators for preparing training text: each module holds one, ``queries`` registers them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel by value, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
