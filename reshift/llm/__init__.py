"""Operators of a training-data pipeline on Spark. Nothing else in the library imports this package.

Functions that run on executors travel by value, so executors need the third-party libraries
only, neither this package nor ``--py-files``.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
