"""Reuse built column expressions within a Spark session.

Building a large expression (the attention reasons, the account brief) costs
one JVM round trip per function call. A built ``Column`` is an immutable,
unresolved expression, so every DataFrame of the session can share it.
``per_context`` memoises a Column builder for the active SparkContext and
rebuilds after the context changes.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import SparkSession


def per_context(fn):
    state: dict = {"context": None, "built": {}}

    @wraps(fn)
    def wrapper(*args):
        session = SparkSession.getActiveSession()
        context = session and session.sparkContext
        if context is not state["context"]:
            state["context"], state["built"] = context, {}
        if args not in state["built"]:
            state["built"][args] = fn(*args)
        return state["built"][args]

    return wrapper
