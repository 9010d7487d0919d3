"""Operators for preparing training text, and the queries that apply them.

Functions that run in tasks travel with them, so executors need only the public
libraries and not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
