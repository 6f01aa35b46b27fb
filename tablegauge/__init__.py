"""Dataset profiling, quality scoring and model evaluation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job; workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
