"""Physical plans as text."""

from __future__ import annotations


def plan_of(df) -> str:
    """The formatted physical plan."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
