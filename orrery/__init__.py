"""Entity time series and the events that disturb them, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Grouped-map functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
