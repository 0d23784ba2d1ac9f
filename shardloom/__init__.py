"""shardloom: Spark jobs that turn text shards and chat tables into tokenizers,
training sequences, chat mixtures and evaluation scores."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel by value: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
