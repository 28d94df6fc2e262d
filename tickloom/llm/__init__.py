"""Operators of a training-data pipeline; nothing else in the library imports them.

Functions that run in tasks are shipped by value, so executors need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
