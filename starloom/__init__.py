"""Starloom: warehouse building, checking and querying on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Arrow helpers travel with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
