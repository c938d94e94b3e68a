"""Operators for building training corpora. Nothing else in the library imports them.

Functions of this package travel to the executors by value: they need numpy, pyarrow and
the like there, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
