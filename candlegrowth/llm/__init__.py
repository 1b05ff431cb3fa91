"""Operators for training-data pipelines; nothing else in the library imports them.

Functions that run in Python workers are sent by value, so the workers need not have the library
on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
