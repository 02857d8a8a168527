"""Operators for large-scale training-data pipelines.

One module per operator; ``queries`` holds the registered ``opN_*`` queries
and their SQL.  Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# task functions travel with their helpers, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
