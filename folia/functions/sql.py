"""Small builders for Spark SQL expression text.

Expression helpers in ``folia.functions`` return SQL text, handed to Spark
with one ``F.expr``/``selectExpr`` call per column: the JVM parses and
analyses the whole expression at once instead of through one py4j round trip
per node.  Lambda variables get fresh names so nested higher-order
functions never shadow each other.
"""

from __future__ import annotations

import itertools
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_names = itertools.count()


def fresh(prefix: str = "v") -> str:
    return f"{prefix}_{next(_names)}"


def lit(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lits(values) -> str:
    return ", ".join(lit(v) for v in values)


def _lambda(fn: Callable[..., str], arity: int) -> str:
    names = [fresh() for _ in range(arity)]
    head = names[0] if arity == 1 else "(" + ", ".join(names) + ")"
    return f"{head} -> {fn(*names)}"


def filter_(arr: str, fn: Callable[..., str], arity: int = 1) -> str:
    return f"filter({arr}, {_lambda(fn, arity)})"


def transform(arr: str, fn: Callable[..., str], arity: int = 1) -> str:
    return f"transform({arr}, {_lambda(fn, arity)})"


def exists(arr: str, fn: Callable[[str], str]) -> str:
    return f"exists({arr}, {_lambda(fn, 1)})"


def aggregate(arr: str, init: str, fn: Callable[[str, str], str]) -> str:
    return f"aggregate({arr}, {init}, {_lambda(fn, 2)})"


def let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and bind it for ``body`` (no expression copy)."""
    return f"transform(array({value}), {_lambda(body, 1)})[0]"


def first(arr: str) -> str:
    """First element or null, without an ANSI error on an empty array."""
    return f"try_element_at({arr}, 1)"


def col(sql: str) -> Column:
    return F.expr(sql)
