"""sluice: event ingestion and forwarding expressed as Spark DataFrame transformations.

Every operator is ``DataFrame -> DataFrame`` built from Spark's built-in
expressions, so the same code runs in batch jobs and in Structured Streaming.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
