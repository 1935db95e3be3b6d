"""Bulk object transfer, integrity and reconciliation as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole: it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
