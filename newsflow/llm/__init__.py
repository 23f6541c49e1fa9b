"""Operators for training-data pipelines. Nothing else in the package imports this folder.

Task functions of this folder travel by value, so that executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
