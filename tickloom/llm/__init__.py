"""Operators of a training-data pipeline; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Ship these modules with the functions that use them, so that executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
