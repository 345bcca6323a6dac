"""Operators for preparing training text. Nothing else in the library imports this.

Functions that run in tasks travel by value, so that executors need the installed
libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
