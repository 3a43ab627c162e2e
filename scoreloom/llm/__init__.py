"""Operators for large training-data pipelines.

Functions that run inside tasks are pickled by value, so executors need the listed
third-party packages but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
