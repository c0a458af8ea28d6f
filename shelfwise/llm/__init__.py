"""Operators of a training-data pipeline over the tables documents, pages and
labels. Nothing outside this subpackage imports it; the driver entry adds its
queries only when it can be imported."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no
# installed copy of this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
