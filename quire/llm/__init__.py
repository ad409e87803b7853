"""Operators for preparing training data at scale.

Python functions of this package that run on executors are shipped by value, so
executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
