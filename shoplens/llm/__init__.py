"""Training-data operators on document, conversation and embedding tables.

Nothing else in the package imports this folder. Its functions travel to the executors by value, so
that workers need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
