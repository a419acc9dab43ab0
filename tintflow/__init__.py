"""Colour analytics over video frames, written as plain Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside Python tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
