"""Event-table and event-stream analytics as plain Spark jobs.

Every public function takes DataFrames and columns and returns a DataFrame.
Functions handed to Python workers are pickled by value, so executors do not
need this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
