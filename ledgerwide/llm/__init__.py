"""Training-data operators; the rest of the package does not know them.

Task functions of this subpackage travel by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
