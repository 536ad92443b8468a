"""Operators of a training-data pipeline; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so that executors need not have
# this package on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
