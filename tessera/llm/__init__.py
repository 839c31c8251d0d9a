"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage, ``corpus_pipeline.py`` and ``tests/llm``
imports it; ``__spark_entry__.py`` registers its queries only when it is there.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
