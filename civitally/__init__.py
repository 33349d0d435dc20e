"""Incident analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with their code, so that workers need neither
# this package nor its folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
