"""Training-data operators: one module per operator, queries in ``queries``.

Functions of this package that run inside tasks are pickled by value, so
executors need no copy of the package on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
