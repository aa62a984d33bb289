"""tallyloom: catalogue reconciliation and training-data operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of the package travel to the executors by value, which then need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
