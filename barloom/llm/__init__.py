"""Training-data operators: dedup, filtering, mixing, sharding and extraction over document tables."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
