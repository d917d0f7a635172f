"""Training-data operators (scoring, filtering, de-duplication, mixing, packing).

Nothing else in the library imports this package.  Functions that run in
Python workers are shipped by value, so a cluster needs no copy of it on its
executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
