"""duskwatch: security-event analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from duskwatch.settings import Settings

# Functions sent to executors carry their code with them, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Settings"]
