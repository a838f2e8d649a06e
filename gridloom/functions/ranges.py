"""Range parameters of reports: wrong ones are errors, never defaults."""

from __future__ import annotations

from datetime import date, timedelta


def report_range(start: str | None = None, end: str | None = None, days: int | None = None, today: date | None = None) -> tuple[date, date]:
    """First and last local day: both ends or neither; else ``days`` (1 to 400, 30 if not given) up to ``today``."""
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    if start is not None and end is not None:
        if days is not None:
            raise ValueError("give days or a start and end, not both")
        first, last = date.fromisoformat(start), date.fromisoformat(end)
        if first > last:
            raise ValueError(f"start {first} is after end {last}")
        span = (last - first).days + 1
    else:
        span = 30 if days is None else days
        last = today or date.today()
        first = last - timedelta(days=span - 1)
    if not 1 <= span <= 400:
        raise ValueError(f"{span} days: a range has 1 to 400")
    return first, last
