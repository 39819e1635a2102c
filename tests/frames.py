"""Small literal frames, and plain-Python answers to compare with."""

from __future__ import annotations

import datetime as dt


def ts(text):
    return None if text is None else dt.datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples, NULLs last."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def column(df, name, by):
    return [r[name] for r in df.orderBy(by).collect()]


SPAN = "user_id bigint, first timestamp, last timestamp, attr int"


def spans(spark, *items):
    return spark.createDataFrame([(k, ts(f), ts(e), a) for k, f, e, a in items], SPAN)
