"""Operators of a large training-data pipeline, each with a thin registered query.

Task code of this package is pickled by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
