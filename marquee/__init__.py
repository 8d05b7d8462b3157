"""Corpus preparation, keyword and vector search, and faceting on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from marquee.session import get_session

# Functions sent to Python workers carry their code with them, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session"]
