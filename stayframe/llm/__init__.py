"""Operators of a training-data pipeline over text documents and embeddings.

Nothing else in the library imports this package; it can be removed whole.
Functions of this package travel to Python workers by value, so executors need
not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
