"""Operators that prepare text corpora for training language models.

Nothing else in the library imports this package. Its functions travel to the executors by
value, so workers need the packages that these use (numpy, pyarrow, ...), but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
