"""Operators of a large-scale training-data pipeline.

One module per operator; ``queries`` registers one query for each.  Nothing
else in the library imports this package.

Functions that run in Python workers are shipped by value, so the executors
need no copy of the package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
