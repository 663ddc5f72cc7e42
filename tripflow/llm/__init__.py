"""Operators for preparing training text; nothing else in the library imports them."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# What runs in Python tasks travels with the task: executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
