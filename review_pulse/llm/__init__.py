"""Operators of a training-data pipeline. Nothing outside this subpackage imports it.

Functions that run inside tasks travel by value, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
