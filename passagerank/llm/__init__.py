"""Operators for building training data: one module per operator.

Python parts of these modules travel with the plan, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
