"""The parameters of one monthly run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from zoneinfo import ZoneInfo


def month_start(day: date, shift: int = 0) -> date:
    """First day of the month ``shift`` months away from the month of ``day``."""
    index = day.year * 12 + day.month - 1 + shift
    return date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class MonthParams:
    """The reported month and the settings every pipeline shares.

    ``time_zone`` decides which month an epoch-millisecond registration falls in.
    Date and month texts are taken as they are, without a time zone.
    """

    start: date
    time_zone: str = "UTC"
    min_uid: int = 1_000_000_000
    max_uid: int = 10_000_000_000
    exchange_area: str = "CN"
    android_label: str = "Android "
    iphone_label: str = "iPhone "

    def __post_init__(self) -> None:
        if self.start.day != 1:
            raise ValueError(f"a reported month starts on day 1, got {self.start}")

    @classmethod
    def for_month(cls, label: str, **settings) -> MonthParams:
        """Parameters for the month ``YYYY-MM``."""
        return cls(datetime.strptime(label, "%Y-%m").date(), **settings)

    @classmethod
    def run_on(cls, today: date, **settings) -> MonthParams:
        """Parameters of a scheduled run: the month before ``today``'s is reported."""
        return cls(month_start(today, -1), **settings)

    @property
    def label(self) -> str:
        return self.start.strftime("%Y-%m")

    @property
    def previous(self) -> date:
        return month_start(self.start, -1)

    @property
    def following(self) -> date:
        return month_start(self.start, 1)

    def millis(self, day: date) -> int:
        """Epoch milliseconds at which ``day`` begins in the run's time zone."""
        midnight = datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(self.time_zone))
        return int(midnight.timestamp()) * 1000
