"""Operators for preparing language-model training data.

Nothing outside this package (except ``corpus_pipeline.py`` at the repository
top) imports it. Functions that run inside Python workers are shipped by value,
so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
