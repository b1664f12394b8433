"""millrace: batch and streaming analytics operators on Spark DataFrames.

Every operator takes and returns DataFrames.  ``plans`` holds the few reusable
plan shapes (order-chunked prefixes, pane-sliced windows, the shared work
folder); ``functions`` are column expressions; ``sources`` read and write;
``operators`` are the bounded forms; ``streaming`` the unbounded ones; and
``catalog`` binds all of them to the benchmark tables with a SQL oracle each.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so that executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
