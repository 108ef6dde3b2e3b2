"""Operators for training data: near copies, tokens, quality, archives, repeats, toxicity, licences, secrets, leaks.

Functions that run in Python workers are sent by value, so that workers need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
