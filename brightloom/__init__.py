"""brightloom: everyday analytics on tables, streams and graphs as Spark jobs.

Every public function takes DataFrames (or a session and a path) and returns a
DataFrame or a fitted model; Spark plans, partitions and runs the work.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
