"""Spark-native operators for moving payloads, following logs and auditing runs.

Every public function takes and returns DataFrames or Columns, so the caller's
plan stays lazy and Catalyst sees all of it.
"""

from pyspark import cloudpickle as _cloudpickle

# Python workers receive this package's functions by value, so executors need
# no installed copy of it.
import sys as _sys

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__version__ = "0.1.0"
