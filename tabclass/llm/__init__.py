"""Training-data operators: scoring, packing, extraction, filters, deduplication.

Each module holds one operator with its own general interface; ``queries``
registers the thin per-contract queries on top of them. Nothing outside this
subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# tasks get the functions themselves: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
