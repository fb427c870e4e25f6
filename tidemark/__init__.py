"""tidemark: a Spark-native engine for point-in-time market-data archives."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with the job, so that executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
