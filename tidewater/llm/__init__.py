"""Operators of a training-data pipeline: near-duplicate joins, decontamination,
secret scans, quality rules and scores, token output, sharding.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""

import sys

from pyspark import cloudpickle

# functions sent to Python workers travel whole, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
