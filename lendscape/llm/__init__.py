"""Operators for training-data pipelines over text corpora."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with their code, so that executors
# don't need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
