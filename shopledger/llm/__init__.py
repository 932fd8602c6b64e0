"""Operators for training-data pipelines, as Spark jobs.

Functions that run in tasks are sent by value, so executors need no copy of this
package on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
