"""Training-data operators: quality, near duplicates, language model scores,
repeated passages, ranking, tokens, packing, shards, exact search, secrets.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
