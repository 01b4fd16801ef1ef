"""Two-zone document store on PySpark: plan, ingest, clean, reconcile."""

import sys

from pyspark import cloudpickle

# Batch functions travel to the executors by value, which therefore need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
