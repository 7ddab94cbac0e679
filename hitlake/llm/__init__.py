"""Operators that prepare text for training language models.

Nothing outside this package imports it. Every operator takes a DataFrame and column
names, keeps the caller's other columns (whatever they are called) and returns a lazy
DataFrame unless its docstring says that it writes an intermediate table.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry this package's code along; it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
