"""Training-data operators: quality, deduplication, privacy, mixing, sharding and tokenization.

Every operator is a function on DataFrames; ``queries.py`` holds the registered
queries. Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
