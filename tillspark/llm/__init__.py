"""Operators and pipeline for large text corpora."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
