"""weftlink: record linkage and corpus preparation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so the package needn't be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
