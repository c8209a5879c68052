"""Registered queries over the given tables, each with an independent SQL statement where one exists."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
