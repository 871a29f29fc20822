"""Training-data operators on Spark. Nothing else in the package imports this one.

Functions that run in tasks travel by value, so executors need numpy, pandas
and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
