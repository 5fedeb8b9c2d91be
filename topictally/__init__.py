"""Counting and ranking of topic records as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Stateful processors and pandas functions are defined in this package. Sending them by value
# means executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
