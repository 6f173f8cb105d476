"""Operators for preparing large text corpora (quality, language, privacy, duplicates, secrets, mixing, sharding).

Nothing else in the library imports this subpackage. Functions that run inside Python workers are pickled by
value, so executors need the third-party packages only, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
