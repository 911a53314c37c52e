"""Training-data operators (fingerprints, mixing, extraction, exact search,
URL filters, language ID, WARC, chat, packing, near-duplicate join).

Nothing else in the library imports this subpackage. Its Python kernels run
in Spark's Python workers; they are pickled by value, so executors need not
have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
