"""waymark: capture-corridor analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package reach executors by value, so a cluster need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
