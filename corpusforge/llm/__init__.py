"""Operators of a training-data pipeline, one module per operator.

``queries`` registers one query per operator; ``corpus_pipeline.py`` at the
repository top chains five of them. Functions that run in Python tasks are
shipped by value, so workers need not have this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
