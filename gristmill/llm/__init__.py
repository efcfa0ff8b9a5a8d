"""Operators for training-data pipelines over documents and web pages.

Nothing else in the library imports this subpackage; see ``queries`` for the registered use.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this subpackage travel to the executors with the job, which need no copy of it.
register_pickle_by_value(sys.modules[__name__])
