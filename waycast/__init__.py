"""Connection matching on Spark: who travels with what, and who must be told."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so the package need not be
# installed on the executors.  What is broadcast must be plain data or pickled like this.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
