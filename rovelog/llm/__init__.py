"""Operators of a training-data pipeline.  Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the plan, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
