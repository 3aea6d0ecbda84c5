"""Operators for large-scale training-data pipelines.

Functions of this package that run in Python workers are pickled by value, so executors
need the libraries of the image but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
