"""Operators for building training corpora. Nothing else in the library imports this subpackage.

Functions sent to executors carry their code along, so workers need no copy of the package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
