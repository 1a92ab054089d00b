"""Community text trend analytics as plain ``DataFrame -> DataFrame`` functions."""

import sys

from pyspark import cloudpickle

# Batch functions travel to the executors whole, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
