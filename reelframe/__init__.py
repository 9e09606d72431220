"""Spark-native data engine for a film/TV catalogue and its recommendations.

Every operator takes and returns DataFrames (or Columns); nothing holds a
session, opens a network connection or passes data through the driver.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
