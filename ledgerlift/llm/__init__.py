"""Training-data operators: sharding, quality, near-duplicates, token files,
URL filters, repeated passages, BPE, decontamination, page text and secrets.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports
it.  Functions that run inside Python workers are shipped by value, so the
executors need no copy of the package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
