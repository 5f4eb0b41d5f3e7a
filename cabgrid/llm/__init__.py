"""Operators for building language-model training data, each a Spark job over whole tables."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so that workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
