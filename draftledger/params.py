"""Run parameters. ``as_of`` replaces every notion of "today" so results are reproducible."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Season:
    """Season year, the as-of date and the activity window in days."""

    year: int = 2001
    as_of: dt.date = dt.date(2001, 11, 5)
    window_days: int = 7
    # time stamped on a refresh; the daily refresh runs at 09:00 UTC
    refreshed_at: dt.datetime | None = field(default=None)

    @property
    def year_text(self) -> str:
        return str(self.year)

    @property
    def run_time(self) -> dt.datetime:
        if self.refreshed_at is not None:
            return self.refreshed_at
        return dt.datetime.combine(self.as_of, dt.time(9, 0))

    @property
    def run_date(self) -> dt.date:
        """Calendar date the refresh runs on (year test of the "finished" check)."""
        return self.run_time.date()


DEFAULT_SEASON = Season()
