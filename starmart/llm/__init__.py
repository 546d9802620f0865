"""Operators that prepare training text: cleaning, de-duplication, mixing and placement of documents."""

import sys

from pyspark import cloudpickle

# Tasks get the code of this package with their functions, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
