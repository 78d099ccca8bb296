"""inkspool: a PySpark-native engine for asset pipelines and their tables."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel by value, so
# executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
