"""tallyspark: analytics over company-filing facts, and training-data operators, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
