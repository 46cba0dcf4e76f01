"""Report parameters (dates, receivable account) as an immutable value."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace
from enum import Enum


def as_bound(value) -> _dt.date | _dt.datetime:
    """A period bound from a date, a datetime or ISO text of either.

    A time of day is kept (midnight gives the date itself); text that is
    neither form is an error, nothing is cut off.
    """
    if not isinstance(value, _dt.date):
        value = _dt.datetime.fromisoformat(str(value).strip())
    if isinstance(value, _dt.datetime) and value.time() == _dt.time() and value.tzinfo is None:
        return value.date()
    return value


class Bounds(Enum):
    """How a period ``(lo, hi)`` treats its end points.

    OPEN      ``lo < d < hi``   invoices and receipts of one period
    HALF_OPEN ``lo < d <= hi``  ledger balances, opening receivables
    """

    OPEN = "open"
    HALF_OPEN = "half_open"


@dataclass(frozen=True)
class ReportParams:
    """Session parameters of the reports.

    ``ar_code`` is the receivable account, ``bf_date`` the brought-forward
    date of the opening balances, ``start``/``end`` the default period.
    """

    ar_code: str = "MA1122"
    bf_date: _dt.date = _dt.date(2020, 12, 31)
    start: _dt.date = _dt.date(2021, 1, 1)
    end: _dt.date = _dt.date(2021, 12, 31)

    def __post_init__(self):
        object.__setattr__(self, "bf_date", as_bound(self.bf_date))
        object.__setattr__(self, "start", as_bound(self.start))
        object.__setattr__(self, "end", as_bound(self.end))

    def period(self, start=None, end=None) -> tuple[_dt.date, _dt.date]:
        """Fill a missing start or end from the defaults, independently."""
        return (as_bound(start) if start is not None else self.start,
                as_bound(end) if end is not None else self.end)

    def with_dates(self, start=None, end=None) -> "ReportParams":
        s, e = self.period(start, end)
        return replace(self, start=s, end=e)


# Parameters used by the test queries, tests and bench (FIXTURES.md).
TEST_PARAMS = ReportParams(ar_code="MA1122", bf_date="1995-12-31",
                           start="1996-12-31", end="1997-12-31")
