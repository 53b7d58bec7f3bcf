"""Operators for training-data pipelines: quality, PII, packing, dedup, decontamination, joins, shards, chat, secrets, toxicity."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with their code, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
