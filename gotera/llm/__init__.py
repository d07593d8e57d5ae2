"""Operators for building training corpora; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# tasks get the functions they call with their closure, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
