"""Flow-transfer data on Spark: cut flows into pieces, put pieces back together, account for them."""

import sys

from pyspark import cloudpickle

# Tasks carry the few functions they run, so that the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
