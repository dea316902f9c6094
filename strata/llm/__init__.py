"""Training-data operators: sharding, decontamination, near duplicates, scoring, encoding.

Nothing outside this package imports it; ``queries.py`` registers one query per
operator and ``corpus_pipeline.py`` chains five of them.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the task, so a cluster
# needs no copy of the package on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
