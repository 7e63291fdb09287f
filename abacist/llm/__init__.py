"""Operators for preparing text corpora; nothing else in the library imports this package.

Functions that run in tasks travel with the job: executors need the libraries, but no copy of this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
