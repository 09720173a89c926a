"""Operators for preparing text corpora, with their registered queries.

Nothing outside this folder (and `corpus_pipeline.py`) imports it. Functions that run inside tasks are shipped by value,
so executors need no copy of the package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
