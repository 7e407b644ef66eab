"""Batch and streaming analytics operators as native PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions by value, so that it need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
