"""Data-engineering operators on Spark."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions by value, so a job runs from any
# folder and on executors that do not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
