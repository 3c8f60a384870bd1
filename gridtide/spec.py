"""Declarations shared by the operators. All are plain values that survive a JSON round trip."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields, replace

from gridtide.functions.steps import Step


class _Json:
    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str):
        raw = json.loads(text)
        known = {f.name for f in fields(cls)}
        unknown = set(raw) - known
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})


#: what a transform does with the rows up to its lag: how far it looks, and what it makes of them
_TRANSFORMS = ("expanding_mean", "expanding_std", "expanding_min", "expanding_max")
_TRANSFORMS += ("rolling_mean", "rolling_std", "rolling_min", "rolling_max", "exponentially_weighted_mean")


@dataclass(frozen=True)
class LagTransform(_Json):
    """A value of the rows up to ``lag`` rows back: all of them (expanding), the last ``window`` of them (rolling), or all with weights that fall by
    ``1 - alpha`` with each row."""

    kind: str
    lag: int
    window: int | None = None
    alpha: float | None = None

    def __post_init__(self):
        if self.kind not in _TRANSFORMS:
            raise ValueError(f"unknown transform {self.kind!r}: one of {_TRANSFORMS}")
        rolling, weighted = self.kind.startswith("rolling"), self.kind == "exponentially_weighted_mean"
        if self.lag < 1 or rolling != (self.window is not None) or weighted != (self.alpha is not None):
            raise ValueError(f"a lag of at least 1, a window for rolling and an alpha for weighted transforms: {self}")
        if rolling and self.window < 1 or weighted and not 0 < self.alpha <= 1:
            raise ValueError(f"window must be positive, alpha above 0 and up to 1: {self}")

    @property
    def name(self) -> str:
        more = f"_window_size{self.window}" if self.window else f"_alpha{self.alpha}" if self.alpha else ""
        # a dot in a column's name would have to be quoted everywhere
        return f"{self.kind}_lag{self.lag}{more}".replace(".", "_")

    @property
    def statistic(self) -> str:
        return self.kind.rsplit("_", 1)[1]

    @property
    def reach(self) -> int:
        return self.lag + (self.window or 1) - 1


@dataclass(frozen=True)
class SeriesSpec(_Json):
    """What makes a table a panel of time series.

    ``layout`` says how ordered work over a series is spread:

    * ``"whole"``: a series is one window partition. One shuffle; right while no series is huge.
    * ``"chunked"``: a series is cut into pieces of ``chunk_rows`` steps that run as separate tasks and
      pass a small carry to each other. Gives the same results for a series of any length.
    * ``"auto"``: measure the longest series first (one aggregate), and take ``"whole"`` only if it has at most
      ``whole_limit`` rows.

    ``unique`` promises at most one row per series and step (as after ``resample``). The extent of the whole table then bounds its
    longest series, and ``"auto"`` has less to measure, or nothing for calendar months.

    ``chunk_micros`` is the length of a piece in microseconds, for series with more than one row per step; ``"auto"`` sets it
    from the largest number of rows in one step.
    """

    keys: tuple[str, ...]
    time: str = "datetime"
    target: str = "target"
    step: str = "1 hour"
    layout: str = "auto"
    chunk_rows: int = 1 << 16
    whole_limit: int = 2_000_000
    chunk_micros: int | None = None
    unique: bool = False

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(self.keys))
        if self.layout not in ("auto", "whole", "chunked"):
            raise ValueError(f"unknown layout: {self.layout!r}")
        if self.chunk_rows < 1:
            raise ValueError("chunk_rows must be positive")
        Step.parse(self.step)

    @property
    def grid(self) -> Step:
        return Step.parse(self.step)

    def with_(self, **changes) -> SeriesSpec:
        return replace(self, **changes)


@dataclass(frozen=True)
class FeatureSpec(_Json):
    """Lag, rolling, expanding and calendar features. The defaults are those of the hourly energy panel.

    ``transform_lags`` all share ``expanding`` and ``rolling_windows``, which are means; ``transforms`` are added one by one.
    """

    # fixed values: default feature settings
    lags: tuple[int, ...] = (48, 72, 96, 120, 144, 168)
    transform_lags: tuple[int, ...] = (48,)
    rolling_windows: tuple[int, ...] = (6, 12, 24, 48)
    expanding: bool = True
    date_parts: tuple[str, ...] = ("month", "dayofweek", "hour")
    transforms: tuple[LagTransform, ...] = ()

    def __post_init__(self):
        for name in ("lags", "transform_lags", "rolling_windows", "date_parts", "transforms"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        made = tuple(LagTransform(**t) if isinstance(t, dict) else t for t in self.transforms)
        object.__setattr__(self, "transforms", made)
        if len({t.name for t in made}) < len(made):
            raise ValueError("a transform is listed twice")
        if any(k < 1 for k in (*self.lags, *self.transform_lags, *self.rolling_windows)):
            raise ValueError("lags and window sizes must be positive")

    @property
    def reach(self) -> int:
        """How many earlier rows a feature row looks at, apart from what all earlier rows go into."""
        rolling = [lag + w - 1 for lag in self.transform_lags for w in self.rolling_windows]
        return max([0, *self.lags, *self.transform_lags, *rolling, *[t.reach for t in self.transforms]])


@dataclass(frozen=True)
class BacktestSpec(_Json):
    """Time-ordered evaluation and training settings."""

    # fixed values: default evaluation settings
    cutoff: str = "2023-01-26 05:00:00"
    n_folds: int = 5
    n_trials: int = 3
    seed: int = 0
    metric: str = "mae"
