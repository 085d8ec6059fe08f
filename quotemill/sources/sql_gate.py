"""Read-only ad-hoc SQL over registered views."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the statement openings a reader may use.
OPENING = re.compile(r"^\s*(SELECT|WITH|SHOW|DESCRIBE)\s", re.IGNORECASE)
# Functions that call into the JVM by name.
REFLECTIVE = re.compile(r"\b(reflect|try_reflect|java_method)\s*\(|\bread_files\s*\(", re.IGNORECASE)
# Nodes of a parsed statement that name a relation, and those that no reader may use.
NAMING = ("UnresolvedRelation", "UnresolvedTableOrView", "UnresolvedTable", "UnresolvedView")
REFUSED = {
    "UnresolvedTableValuedFunction": "table functions", "PlanWithUnresolvedIdentifier": "names made of expressions",
    "ScriptTransformation": "scripts", "DescribeQueryCommand": "descriptions of queries",
}


def _sequence(items: Any) -> list[Any]:
    return [items.apply(i) for i in range(items.size())]


def _confined(plan: Any, allowed: frozenset[str]) -> None:
    """Walk a parsed statement, subqueries included; only the allowed names and those that WITH gives may be read."""
    kind = plan.nodeName()
    if kind in REFUSED:
        raise ValueError(f"{REFUSED[kind]} are not allowed")
    if kind in NAMING:
        parts = _sequence(plan.multipartIdentifier())
        if len(parts) != 1 or parts[0].lower() not in allowed:
            raise ValueError(f"{'.'.join(parts)!r} is not one of the given tables")
    if kind == "UnresolvedWith":
        # A name stands for its query from the next one on; inside its own it would still mean what stood there before.
        for relation in _sequence(plan.cteRelations()):
            _confined(relation._2(), allowed)
            allowed = allowed | {relation._1().lower()}
    for part in (*_sequence(plan.children()), *_sequence(plan.subqueries())):
        _confined(part, allowed)


def query_sql(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None,
              views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run one read-only statement with named parameters over the given views and nothing else.

    The opening word alone would let WITH .. INSERT through. A SELECT or WITH text is therefore analysed
    as a subquery first, a place where Spark's grammar accepts nothing but a query. The parsed statement is walked before anything runs: other
    views of the session, catalog tables, paths, table functions and scripts are refused, as are functions that reach into the JVM. No setting of
    the session changes, and the given views are gone when this returns.
    """
    if REFLECTIVE.search(text.replace("`", "")):
        raise ValueError("functions that call the JVM by name are not allowed")
    opening = OPENING.match(text)
    if not opening:
        raise ValueError(f"only SELECT, WITH, SHOW and DESCRIBE are allowed, got {text[:50]!r}")
    args = dict(args or {})
    parser = spark._jsparkSession.sessionState().sqlParser()
    is_query = opening.group(1).upper() in ("SELECT", "WITH")
    parsed = parser.parsePlan(f"SELECT * FROM (\n{text}\n)" if is_query else text)
    _confined(parsed, frozenset(n.lower() for n in views or {}))
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    try:
        if is_query:
            spark.sql(f"SELECT * FROM (\n{text}\n)", args=args)
        return spark.sql(text, args=args) if args else spark.sql(text)
    finally:
        for name in views or {}:
            spark.catalog.dropTempView(name)
