"""Event analytics on tables and streams, written as plain DataFrame functions."""

import sys

from pyspark import cloudpickle

# ship the few Python functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
