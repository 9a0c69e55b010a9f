"""Document retrieval and question answering over large tables, as Spark jobs.

Every operator takes DataFrames and returns a DataFrame (or, for column helpers, a Column), so a
pipeline is a chain of ``DataFrame.transform`` calls.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
