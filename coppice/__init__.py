"""Gradient-boosted classification pipelines as Spark jobs.

Subpackages: ``functions`` (column expressions), ``sources`` (reading, writing
and the tracking tables), ``operators`` (DataFrame in, DataFrame out), ``plans``
(training, search, batch scoring) and ``streaming``.
"""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors by value, so the package does not have to
# be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
