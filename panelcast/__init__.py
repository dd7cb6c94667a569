"""Weekly seasonal panels on Spark: features, season detection, seasonal ARIMA, evaluation."""

import sys

from pyspark import cloudpickle

# Task functions travel whole with the job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
