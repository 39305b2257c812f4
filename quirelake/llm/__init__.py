"""Operators for preparing training text: deduplication, filters, mixing, tokens.

Functions of this package travel to the executors by value, so they need no
copy of the library there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
