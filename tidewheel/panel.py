"""The panel description every series operator takes."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Panel:
    """Column roles of a keyed time series.

    ``keys`` and ``time`` together must identify a row.  ``daily`` states that ``time`` is a calendar date, so a
    series can never be longer than the calendar (366 rows a year) and one task can hold it.  Leave it False for
    anything finer grained: series operators then cut each series into pieces that overlap by the reach of the
    requested windows, and no task ever receives a whole series.
    """

    keys: tuple[str, ...]
    time: str
    value: str
    daily: bool = False

    @property
    def order(self) -> tuple[str, ...]:
        return (*self.keys, self.time)
