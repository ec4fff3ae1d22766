"""Operators for preparing training data at corpus scale.

Nothing outside this package imports it. Functions of this package that run in
Spark's Python workers are shipped with the plan, so executors need no copy of it.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
