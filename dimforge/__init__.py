"""dimforge: a Spark-native toolkit for building a dimensional warehouse on a lake.

Every operator is a plain ``DataFrame -> DataFrame`` function written with
Spark built-ins, so Catalyst sees the whole plan (pushdown, pruning, AQE).
"""

from dimforge.session import get_session, work_dir  # noqa: F401

__all__ = ["get_session", "work_dir"]
