"""Clinical-cohort analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Python workers need not have the package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])
