"""Month labels (``yyyy-MMM``), day text, epoch seconds and recency filters."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL_FORMAT = "yyyy-MMM"   # e.g. 2024-Jan
DAY_FORMAT = "yyyy-MM-dd"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_label(c) -> Column:
    return F.date_format(_col(c), LABEL_FORMAT)


def parse_month_label(c) -> Column:
    """``2024-Jan`` -> date 2024-01-01; NULL when not a label."""
    return F.try_to_date(_col(c), LABEL_FORMAT)


def day_text(c) -> Column:
    return F.date_format(_col(c), DAY_FORMAT)


def parse_day(c) -> Column:
    return F.to_date(_col(c), DAY_FORMAT)


def same_month(a, b) -> Column:
    return F.trunc(_col(a).cast("date"), "MM") == F.trunc(_col(b).cast("date"), "MM")


def epoch_to_timestamp(c) -> Column:
    """Unix seconds -> timestamp (UTC session)."""
    return F.timestamp_seconds(_col(c))


def in_months(c, labels: list[str]) -> Column:
    """Whether a timestamp column lies in one of the months ``labels`` (``yyyy-MMM``): plain ranges over the
    column, one for each run of months, so they reach the scan."""
    starts = sorted({_dt.datetime.strptime(x, "%Y-%b") for x in labels})
    after = lambda d: _dt.datetime(d.year + d.month // 12, d.month % 12 + 1, 1)
    runs: list[list[_dt.datetime]] = []
    for d in starts:
        if runs and runs[-1][1] == d:
            runs[-1][1] = after(d)
        else:
            runs.append([d, after(d)])
    out = F.lit(False)
    for i, (a, b) in enumerate(runs):
        one = (_col(c) >= F.lit(a)) & (_col(c) < F.lit(b))
        out = one if i == 0 else out | one
    return out


def recent_filter(c, as_of: str | _dt.date, mode: str = "month_number") -> Column:
    """Rows of the current and the previous month relative to ``as_of``.

    ``month_number`` keeps the source's rule ``month(ts) >= month(as_of) - 1``
    which ignores the year (in January it keeps everything); ``calendar``
    is ``ts >= first day of the previous month`` and pushes down to parquet.
    """
    as_of_d = _dt.date.fromisoformat(str(as_of)[:10])
    if mode == "month_number":
        return F.month(_col(c)) >= F.lit(as_of_d.month - 1)
    if mode == "calendar":
        y, m = (as_of_d.year, as_of_d.month - 1) if as_of_d.month > 1 else (as_of_d.year - 1, 12)
        start = _dt.datetime(y, m, 1)
        return _col(c) >= F.lit(start)
    raise ValueError(f"unknown recency mode {mode!r}")
