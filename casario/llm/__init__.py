"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Each operator works on a frame with
an id and a text (or url) column, looks only at the columns it names, and returns either
the ids with its findings or the rows it was given, changed.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value: it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
