"""Data jobs for tables and streams, written with the public Spark API.

Every operator takes DataFrames and returns a DataFrame, so the same call
serves a table, a micro-batch inside ``foreachBatch`` and, where Spark allows
it, an unbounded stream.
"""

import sys

from pyspark import cloudpickle

# User functions travel to the workers by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
