"""Operators for preparing training text; nothing else in the package imports this one.

What runs inside tasks is sent along with them, so executors need not have
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
