"""Corpus token statistics as composable Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from tokenloom.params import Params

# Functions that run in Python workers travel with the job; executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Params"]
