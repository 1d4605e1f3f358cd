"""Look at the physical plan of a DataFrame."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    """The physical plan before adaptive changes."""
    return df._jdf.queryExecution().sparkPlan().toString() + "\n" + executed_plan(df)


def executed_plan(df: DataFrame) -> str:
    """The plan Spark would run (the initial plan where execution is adaptive)."""
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(df: DataFrame, node: str) -> int:
    """How often an operator occurs in the plan that would run, e.g. Exchange, SortMergeJoin."""
    return len(re.findall(rf"(?<![A-Za-z]){node}\b", executed_plan(df)))


def exchanges(df: DataFrame) -> int:
    """Shuffles in the plan (broadcasts and reused shuffles are not counted)."""
    return count_nodes(df, "Exchange")


def python_nodes(df: DataFrame) -> int:
    """Operators that would send rows to Python workers."""
    return len(re.findall(r"(?:ArrowEval|BatchEval|MapIn|FlatMapGroupsIn)(?:Python|Pandas|Arrow)", executed_plan(df)))
