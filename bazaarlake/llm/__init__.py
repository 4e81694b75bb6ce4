"""Operators for training-data pipelines over documents, pages and vectors; nothing else in the library imports them.

Task functions are pickled by value, so executors need the third-party packages but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
