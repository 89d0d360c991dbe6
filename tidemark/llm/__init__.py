"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Its functions reach
Python workers by value, so a job needs the package on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
