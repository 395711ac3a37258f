"""Order analytics on Spark: ingest, lakehouse tables, BI models and shop queries."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
