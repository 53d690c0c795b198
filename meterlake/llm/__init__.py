"""Training-data operators.

Nothing else in the library imports this subpackage.  The functions that run
inside Spark tasks are shipped with each job (pickled by value), so executors
need no copy of the package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
