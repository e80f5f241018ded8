"""Training-data operators for text corpora; nothing else in the library imports this package."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run in tasks travel with the job, so executors need not have this package installed.
register_pickle_by_value(sys.modules[__name__])
