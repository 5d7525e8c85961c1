"""Small shared helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a ``Column``."""
    return F.col(c) if isinstance(c, str) else c


def require_columns(df, *names: str) -> None:
    """Eager schema check (no Spark job): raise if a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; got {df.columns}")


def computed(df, **columns):
    """``df`` with ``columns`` added or replaced, each computed once per row.

    A filter on a projected column is pushed below the projection, where every mention of
    the column is its whole expression again; it does not pass a generator's columns.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    return df.select(*[F.col(f"`{c}`") for c in kept], F.inline_outer(row)).select(
        *[F.col(f"`{c}`") for c in df.columns], *[c for c in columns if c not in df.columns])


def explode_rows(df, keep: list, array_col, names: tuple, with_pos: bool = False):
    """Rows of ``array_col`` (with ``keep`` columns), empty arrays giving none.

    Uses the *outer* generator and drops its NULL row afterwards: a plain
    ``explode`` makes the optimizer infer ``size(array) > 0`` below the
    generator, which re-evaluates an expensive array expression (regex
    splits, n-grams) in the pushed-down filter.
    """
    if with_pos:
        gen = F.posexplode_outer(array_col).alias(*names)
    else:
        gen = F.explode_outer(array_col).alias(*names)
    return df.select(*keep, gen).filter(F.col(names[-1]).isNotNull())
