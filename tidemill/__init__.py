"""Analytics jobs written directly on the PySpark DataFrame, SQL, streaming and ML APIs."""

import sys

from pyspark import cloudpickle

# Functions used inside tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
