"""Feature, scoring and evaluation jobs for insurance records on Spark."""

import sys

from pyspark import cloudpickle

from claimflow.session import build_session, shared_dir

# Executors need no copy of the package: the few Python functions that run on
# them travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "shared_dir"]
