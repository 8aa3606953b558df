"""peneira: preparing and summarising tables and text with Spark.

Every function takes and returns Spark DataFrames or Columns; nothing here
keeps state besides the SparkSession it is given.
"""

import sys

from pyspark import cloudpickle

# Functions of this package go to the workers by value: a cluster whose executors do
# not have the package installed runs them all the same.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
