"""Driver-side parameter arithmetic (a handful of scalars, never data)."""

from __future__ import annotations

from datetime import date, datetime, timedelta


def _parse_day(text: str) -> date:
    return datetime.strptime(str(text), "%Y%m%d").date()


def day_list(campaign_start_date: str, periods: int = 1) -> list[str]:
    """``periods`` consecutive days ending on the start date, inclusive, as yyyymmdd."""
    if periods < 1:
        raise ValueError("periods must be >= 1")
    end = _parse_day(campaign_start_date)
    return [(end - timedelta(days=i)).strftime("%Y%m%d") for i in range(periods - 1, -1, -1)]


def day_bounds(campaign_start_date: str, periods: int = 1) -> tuple[int, int]:
    """(first, last) day of ``day_list`` as yyyymmdd integers."""
    days = day_list(campaign_start_date, periods)
    return int(days[0]), int(days[-1])


def date_bounds(start_date: str | None, end_date: str | None) -> tuple[str | None, str | None]:
    """'YYYY-MM-DD' bounds -> inclusive 'yyyymmddT000000' / 'yyyymmddT235959' text.

    Empty or None means no bound; a malformed date raises ValueError.
    """
    lo = hi = None
    if start_date:
        lo = datetime.strptime(start_date, "%Y-%m-%d").strftime("%Y%m%dT000000")
    if end_date:
        hi = datetime.strptime(end_date, "%Y-%m-%d").strftime("%Y%m%dT235959")
    return lo, hi
