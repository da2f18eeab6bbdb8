"""Operators of a training-data pipeline: language, toxicity, duplicates, mixing, packing, quality.

Nothing else in the library imports this package. Its functions are pickled by
value, so executors need no copy of the package on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
