"""Operators for preparing training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# The Python functions of these modules travel to the executors by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
