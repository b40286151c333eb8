"""quern: curation, audit and corpus operators as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so only the driver needs it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
