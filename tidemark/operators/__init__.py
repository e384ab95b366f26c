"""DataFrame operators."""

import sys

from pyspark import cloudpickle

# What runs in Python tasks is sent by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
