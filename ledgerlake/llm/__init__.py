"""Training-data preparation operators: one module per operator.

Every operator takes DataFrames plus column names and returns DataFrames; the
registered queries (``queries.py``) are thin callers.  Nothing else in the
library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Task code of this subpackage travels with the job, so executors need no
# installed copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
