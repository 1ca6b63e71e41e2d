"""Operators of a training-data pipeline (one module per operator).

Functions of this package that run inside tasks travel by value, so a session
started from any folder, with workers that cannot import the package, works.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
