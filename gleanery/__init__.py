"""Review-corpus curation on Spark: land, merge, clean, label, repair, split."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with the job, so that executors need
# no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
