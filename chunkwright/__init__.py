"""Retrieval test sets from chunk tables, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions handed to Arrow stages travel by value, so executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
