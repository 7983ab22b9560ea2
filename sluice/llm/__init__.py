"""Operators for building training corpora, one module per operator.

``REGISTRY`` maps query names to callables ``(spark, sf_dir)``; ``ORACLES``
maps the names that SQL can express to DuckDB SQL.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
