"""Operators for large text corpora."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: functions sent to them carry their code along.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
