"""Spark jobs for learning on wide tables: generate, clean, featurise, fit, score, search."""

import sys

from pyspark import cloudpickle

# Ship our functions with each job, so that executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
