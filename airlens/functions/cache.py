"""Reuse of built column expressions.

The scoring and pivot expressions are hundreds of Column nodes; building
them costs one JVM round trip per node. A Column is an immutable,
unresolved expression, so one built per JVM can serve every DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import SparkContext

_CACHE: dict[tuple, tuple[Any, Any]] = {}


def cached(key: tuple, build: Callable[[], Any]) -> Any:
    sc = SparkContext._active_spark_context
    jvm = sc._jvm if sc is not None else None
    k = (id(jvm), *key)
    hit = _CACHE.get(k)
    if hit is not None and hit[0] is jvm:
        return hit[1]
    value = build()
    _CACHE[k] = (jvm, value)            # holding the JVM view keeps its id unique
    return value
