"""Team-sport match analytics as Spark DataFrame functions and batch jobs."""

import sys

from pyspark import cloudpickle

# Functions run on executors travel with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
