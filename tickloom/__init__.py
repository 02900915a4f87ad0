"""Market-risk analytics on Spark: tick windows, risk marts, alerts and retrieval."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so that it need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
