"""Operators for preparing training text; nothing else in the package imports this folder.

Their Arrow functions are sent to the executors by value, so the package need be installed on the driver alone.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
