"""Small helpers shared by the plan modules."""

from __future__ import annotations

from pyspark.sql import functions as F

from .views import with_views


class Registry:
    """Collects queries and the SQL each one is checked against."""

    def __init__(self, extra: dict[str, str] | None = None):
        self.queries, self.sql, self.extra = {}, {}, dict(extra or {})

    def query(self, name: str, body: str | None = None):
        def register(fn):
            self.queries[name] = fn
            if body:
                self.sql[name] = with_views(body, self.extra)
            return fn
        return register


# averages of money can end exactly on half a unit; a fixed nudge below it makes both engines round alike
NUDGE = 3.3e-7


def r(df, nudge=(), **digits):
    """Round the named columns for a stable comparison."""
    return df.select(*[F.round(F.col(c) + (NUDGE if c in nudge else 0.0), digits[c]).alias(c) if c in digits else F.col(c)
                       for c in df.columns])


def rounded(columns: str) -> str:
    """'a:4 b:6 c' -> SQL select list with the same rounding."""
    out = []
    for part in columns.split():
        name, _, digits = part.partition(":")
        out.append(f"round({name},{digits}) AS {name}" if digits else name)
    return ", ".join(out)
