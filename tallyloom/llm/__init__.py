"""Operators for preparing language-model training data; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions of this package travel with the task, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
