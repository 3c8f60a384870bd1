"""Arithmetic on a regular time step, for zone-less (TIMESTAMP_NTZ) columns.

Everything is built from intervals, ``datediff`` and the clock parts, so no value passes through the session
time zone and a daylight-saving change can neither lose nor repeat an hour.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_MONTHS = {"month": 1, "quarter": 3, "year": 12}
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def micros(t: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp."""
    t = F.col(t) if isinstance(t, str) else t
    since = t - F.expr(_EPOCH)
    seconds = since.cast("interval second").cast("bigint")
    rest = since - F.expr("interval '1' second") * seconds
    # a million times the rest, in seconds, is the rest in microseconds
    return seconds * 1_000_000 + (rest * 1_000_000).cast("interval second").cast("bigint")


@dataclass(frozen=True)
class Step:
    """``n`` units of a fixed length (second … week) or of calendar months (month, quarter, year)."""

    n: int
    unit: str

    @classmethod
    def parse(cls, text: str) -> Step:
        n, _, unit = text.strip().partition(" ")
        if not unit:
            n, unit = "1", n
        unit = unit.strip().lower().removesuffix("s")
        if unit not in _MICROS and unit not in _MONTHS:
            raise ValueError(f"unknown time step: {text!r}")
        if int(n) < 1:
            raise ValueError(f"a time step must be positive: {text!r}")
        return cls(int(n), unit)

    @property
    def is_calendar(self) -> bool:
        return self.unit in _MONTHS

    @property
    def months(self) -> int:
        return self.n * _MONTHS[self.unit]

    @property
    def length(self) -> int:
        """Length in microseconds (fixed-length units only)."""
        return self.n * _MICROS[self.unit]

    @property
    def about(self) -> int:
        """Length in microseconds; a month counts as 30 days."""
        return self.months * 30 * _MICROS["day"] if self.is_calendar else self.length

    def interval(self) -> Column:
        if self.is_calendar:
            return F.expr(f"interval '{self.months}' month")
        if self.unit == "week":
            return F.expr(f"interval '{7 * self.n}' day")
        return F.expr(f"interval '{self.n}' {self.unit}")

    def index(self, t: Column | str) -> Column:
        """Number of whole steps since 1970-01-01."""
        t = F.col(t) if isinstance(t, str) else t
        if self.is_calendar:
            month = (F.year(t).cast("bigint") - 1970) * 12 + F.month(t) - 1
            return month if self.months == 1 else F.floor(month / self.months)
        day = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
        if self.unit == "day":
            return day if self.n == 1 else F.floor(day / self.n)
        if self.unit == "hour":
            hour = day * 24 + F.hour(t)
            return hour if self.n == 1 else F.floor(hour / self.n)
        # exact integer arithmetic: a double cannot hold every microsecond count
        m = micros(t)
        return F.call_function("div", m - F.pmod(m, F.lit(self.length)), F.lit(self.length))

    def start(self, index: Column) -> Column:
        """First instant of step number ``index`` (inverse of :meth:`index`)."""
        return F.expr(_EPOCH) + self.interval() * index

    def floor(self, t: Column | str) -> Column:
        """Start of the step that holds ``t``."""
        return self.start(self.index(t))

    def plus(self, t: Column, k: Column) -> Column:
        """``t`` moved by ``k`` steps."""
        return t + self.interval() * k

    def between(self, a: Column, b: Column) -> Column:
        """Whole steps from ``a`` to ``b`` (``a`` ≤ ``b``)."""
        if self.is_calendar:
            months = (F.year(b).cast("bigint") - F.year(a)) * 12 + F.month(b) - F.month(a)
            return F.call_function("div", months, F.lit(self.months))
        return F.call_function("div", micros(b) - micros(a), F.lit(self.length))
