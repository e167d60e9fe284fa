"""Operators for preparing training text; each module holds one operator and its contract.

Functions of this package that run inside tasks are sent to the executors by value, so that these need only the
third-party libraries and not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
