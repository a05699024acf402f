"""Operators of a training-data pipeline: mixing, personal data, HTML extraction, exact and near
duplicates, quality and toxicity models, byte-pair encoding, exact vector search.

Nothing outside this package imports it except the guarded registration in ``__spark_entry__.py``.
Task-side functions are shipped by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
