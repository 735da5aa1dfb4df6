"""Operators for preparing training text: language, licences, quality, sharding, duplicates, tokens and packing."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with the plan, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
