"""Training-data operators: deduplication, search, filtering, mixing, tokenising, formatting.

Nothing else in the package imports this one; ``queries`` holds the registered queries. Its
functions travel to the Python workers by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
