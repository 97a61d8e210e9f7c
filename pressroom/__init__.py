"""Article analytics on Spark."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Functions of this package travel to Python workers by value, so a worker needs
# no copy of the package on its path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
