"""Operators for preparing training text. Nothing else in the library imports this package.

Functions that run in tasks are sent to the executors by value, so that these
need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
