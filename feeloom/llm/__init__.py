"""Operators for training-data pipelines over text corpora. Nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value, so they need no copy of this package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
