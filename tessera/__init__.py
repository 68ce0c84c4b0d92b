"""A PySpark-native record-linkage and corpus engine."""

import sys

from pyspark import cloudpickle

# Functions travel to executors by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
