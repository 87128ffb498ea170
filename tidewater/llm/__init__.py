"""Training-data operators on PySpark.

Nothing else in the library imports this subpackage. Its functions are sent to
the Python workers by value, so executors need numpy, pyarrow and zstandard but
not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
