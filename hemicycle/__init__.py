"""Spark-native analytics for long official transcripts."""

import sys

from pyspark import cloudpickle

# Functions run by Python workers travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
