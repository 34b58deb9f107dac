"""Operators of a training-data pipeline.

One module per operator; ``registered`` holds their queries. Nothing else in
the library imports this package. Functions that run in tasks are shipped by
value, so executors need no copy of the package on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
