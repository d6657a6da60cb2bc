"""Operators for training-data pipelines over documents, conversations and embeddings."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package installed
