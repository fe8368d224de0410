"""Document analytics on Spark: DataFrame operators, sources, sinks and streaming plans.

Functions handed to Python workers are pickled by value, so executors need not
have this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
