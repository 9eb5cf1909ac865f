"""Operators for training-data pipelines. Nothing outside this package imports it.

Functions of this package travel to the executors by value: they need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
