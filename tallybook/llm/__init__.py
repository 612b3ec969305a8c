"""Operators of a training-data pipeline over documents, pages and conversations."""

import sys

from pyspark import cloudpickle

# Functions that run on executors are sent with their code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
