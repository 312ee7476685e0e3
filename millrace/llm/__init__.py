"""Operators for training-data pipelines over large text and embedding tables.

Functions that run inside tasks are shipped with the job by value, so that
executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
