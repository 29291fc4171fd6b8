"""kelpline: record linkage, label propagation and corpus preparation on Spark."""

import sys

from pyspark import cloudpickle

# Functions travel to Python workers with their code, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
