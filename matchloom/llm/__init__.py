"""Operators for large-scale training-data preparation. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel with the tasks, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
