"""Operators for training data. Nothing outside this folder imports them; `queries.py` registers one query for each."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
