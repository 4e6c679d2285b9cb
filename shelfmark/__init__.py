"""Retail data pipelines and training-data preparation on PySpark."""

import sys

from pyspark import cloudpickle

#: Functions of this package travel to the executors by value, so that these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
