"""Corpus curation and training-corpus preparation as Spark DataFrame operators.

Every operator takes and returns a ``DataFrame``; column functions take and
return a ``Column``. See the README for the operator list.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Ship the package's own functions by value inside the UDF pickle, so that
# executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
