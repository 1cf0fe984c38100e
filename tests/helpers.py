"""Small helpers shared by the tests."""

import io
import re
from contextlib import redirect_stdout


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def executed_plan(df) -> str:
    """Final adaptive plan after running the frame."""
    df.write.format("noop").mode("overwrite").save()
    rows = df._jdf.queryExecution()
    rows.executedPlan().execute().count()
    return rows.executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"\bExchange (?:hash|range|single|RoundRobin)", plan_of(df), re.I))


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]
