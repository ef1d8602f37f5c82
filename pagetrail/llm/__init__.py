"""Operators for preparing training data; nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# executors run the functions of this folder as the driver sends them and need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
