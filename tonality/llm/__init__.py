"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Its task-side kernels
need numpy and pyarrow (and, where stated, tokenizers or pyahocorasick) on the
workers; the package itself travels inside the tasks, pickled by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
