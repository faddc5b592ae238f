"""Document analytics, provenance and training-data operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the plan, so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
