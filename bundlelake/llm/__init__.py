"""Training-data operators: cleaning, deduplication, decontamination, mixing and packing.

Functions of this package travel to the executors with the job, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
