"""Event-stream and table analytics for PySpark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

from millrace.session import get_session

# Functions sent to executors carry their code, so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session"]
