"""Dates, windows and weights of one purchase-prediction run."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

# Action type codes of the log.
BROWSE = 1
PURCHASE = 2
CART = 5
ACTION_TYPES = (1, 2, 3, 4, 5)

# Default windows (days), label horizon (days) and smoothing weights.
WINDOWS = (1, 3, 7, 21)
LABEL_HORIZON = 3
ONE_KEY_PRIOR = 1000
TWO_KEY_PRIOR = 500
COMMENT_PRIOR = 50
REGISTRATION_AS_OF = date(2019, 1, 1)


@dataclass(frozen=True)
class Calendar:
    """All dates of one run.

    ``anchors`` are the sampled days. Features look at ``[anchor - n + 1, anchor]`` for each
    window ``n``; labels look at ``(anchor, anchor + horizon]``. Conversion rates use days before
    ``conversion_before``, long-run counts use days before ``history_before``.
    """

    anchors: tuple[date, ...]
    conversion_before: date
    history_before: date
    train_before: date
    windows: tuple[int, ...] = WINDOWS
    horizon: int = LABEL_HORIZON
    as_of: date = REGISTRATION_AS_OF

    def __post_init__(self) -> None:
        if not self.anchors:
            raise ValueError("a calendar needs at least one anchor day")
        if list(self.anchors) != sorted(set(self.anchors)):
            raise ValueError("anchors must be distinct and in ascending order")
        if not self.windows or min(self.windows) < 1:
            raise ValueError("windows must be positive numbers of days")

    @classmethod
    def ending(cls, last_day: date, n_anchors: int = 8, **overrides) -> "Calendar":
        """Calendar whose anchors are the last ``n_anchors`` days up to ``last_day``."""
        anchors = tuple(last_day - timedelta(days=i) for i in reversed(range(n_anchors)))
        dates = {
            "anchors": anchors,
            "conversion_before": anchors[0],
            "history_before": last_day - timedelta(days=20),
            "train_before": last_day - timedelta(days=2),
        }
        return cls(**{**dates, **overrides})

    @property
    def first(self) -> date:
        return self.anchors[0]

    @property
    def last(self) -> date:
        return self.anchors[-1]

    @property
    def before_last(self) -> date:
        """The anchor before the last, which need not be the day before it."""
        if len(self.anchors) < 2:
            raise ValueError("scoring two days needs at least two anchors")
        return self.anchors[-2]

    @property
    def reach(self) -> int:
        """Length in days of the longest window."""
        return max(self.windows)

    @property
    def consecutive(self) -> bool:
        return (self.last - self.first).days + 1 == len(self.anchors)

    def spans(self, longest: int = 63) -> list["Calendar"]:
        """Split into calendars whose anchors and windows together cover at most ``longest`` days."""
        if self.reach >= longest:
            raise ValueError(f"windows must be shorter than {longest} days")
        parts: list[list[date]] = []
        for anchor in self.anchors:
            if parts and (anchor - parts[-1][0]).days + self.reach <= longest:
                parts[-1].append(anchor)
            else:
                parts.append([anchor])
        return [replace(self, anchors=tuple(part)) for part in parts]
