"""Where pages come from. The plug-ins' Python functions are shipped to executors by value, so those need no installed copy."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
