"""Operators for preparing training data. Nothing else in the library imports this package.

The functions that run inside tasks are pickled by value, so executors need
Python, numpy and pyarrow, but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
