"""Order-flow and volatility analytics as PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Python functions that run inside tasks travel with their code, so executors
# need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
