"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this package.  Functions that run in tasks
travel with their code, so executors need no installation of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
