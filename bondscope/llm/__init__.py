"""Operators for preparing training text: dedup, scoring, mixing, packing, formatting, sharding.

Workers get the code of this subpackage with each task, so it needs no installation there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
