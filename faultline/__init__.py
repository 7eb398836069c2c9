"""Retrieval-and-triage of alarm streams as Spark jobs."""

import sys

from pyspark import cloudpickle

# The Arrow functions below travel to the executors inside the plan, so a cluster does not need
# this package installed on every worker.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
