"""Training-data operators: quality scoring, WARC archives, fingerprints,
secret scans, source mixing, near-duplicate detection, packing, language
identification and HTML extraction.

Nothing outside this subpackage imports it.  Functions that run in Python
workers are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
