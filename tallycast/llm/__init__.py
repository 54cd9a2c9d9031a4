"""Operators for training-data pipelines; nothing else in the library imports this package.

One module per operator (``op01`` .. ``op10`` names are in ``queries``), shared helpers in
``common``. Every operator takes and returns DataFrames and keeps its own interface; the
registered ``opN_<name>`` queries in ``queries`` derive the digest columns from them.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
