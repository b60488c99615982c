"""Training-data operators for language models.

Nothing else in the library imports this subpackage.  Task functions are
shipped to the executors by value, so a cluster needs no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
