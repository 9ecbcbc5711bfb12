"""Functional and taxonomic profiling of sequencing data as plain PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# What runs in Python workers travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
