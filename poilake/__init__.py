"""poilake: point-of-interest lakehouse operators as PySpark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions that tasks run travel with the job, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
