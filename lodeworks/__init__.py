"""Data-mining operators for Spark: every operator takes and returns DataFrames."""

import sys

from pyspark import cloudpickle

# The NumPy bodies of mapInArrow and applyInPandas travel inside the task, so the
# package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
