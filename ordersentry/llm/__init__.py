"""Operators of a training-data pipeline over text corpora.

Nothing outside this subpackage imports it; ``queries.py`` holds the
registered queries and ``oracle.py`` their DuckDB SQL.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a worker
# needs no copy of the repository on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
