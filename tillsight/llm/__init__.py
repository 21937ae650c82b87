"""Training-data operators: quality, deduplication, decontamination, mixing.

One module per operator; ``registry`` holds the registered queries and their
SQL. Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so that a
# cluster needs no copy of the package on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
