"""Clickstream analytics on PySpark: DataFrame-to-DataFrame operators for batch tables and Structured Streaming."""

import sys

from pyspark import cloudpickle

from streamlytics.session import build_session, shared_dir, tune

# Python workers get this package's functions and processors by value, so the executors need not
# have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "shared_dir", "tune"]
