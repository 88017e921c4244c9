"""Every tunable of the pipeline in one immutable place."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Thresholds:
    """Cut points on hits per unique user. The alert bound is strict, the ladder bounds open each band."""

    alert: float = 2.5
    suspicious: float = 2.0
    high_risk: float = 4.0
    critical: float = 7.0


@dataclass(frozen=True)
class PipelineConfig:
    window: str = "10 seconds"
    watermark: str = "30 seconds"
    trigger: str = "2 seconds"
    # Zone in which producers write their (offset-less) timestamps, and in which reports show time.
    event_zone: str = "+02:00"
    # "approx" (HLL++, fixed-size state) or "exact" (state and shuffle grow with distinct users).
    distinct: str = "approx"
    # Relative standard deviation of the sketch: 0.05 -> 416 B per group, 0.01 -> about 13 KB.
    rsd: float = 0.05
    # Batches only: set it when files are not written in time order. Every task then sees most windows, and sending
    # one sketch per task and window would cost more than sending the events themselves once.
    unordered_input: bool = False
    # Batches of several grains with approx users: group by all keys once and merge the grains from these groups, instead
    # of multiplying the events by the number of grains. It pays where a window has many more events than pairs of
    # campaign and country; with short windows there are more groups than it saves.
    lattice: bool = False
    # False counts events without an IP as hits (they can never count as users).
    exclude_malformed: bool = False
    # Shown in alert texts for events without a campaign; None leaves the whole text NULL.
    null_campaign_label: str | None = "(none)"
    thresholds: Thresholds = field(default_factory=Thresholds)

    def __post_init__(self) -> None:
        if self.distinct not in ("approx", "exact"):
            raise ValueError(f"distinct must be 'approx' or 'exact', not {self.distinct!r}")
        if not 0 < self.rsd < 0.4:
            raise ValueError("rsd must lie in (0, 0.4)")
        if not re.fullmatch(r"[+-]\d{2}:\d{2}", self.event_zone):
            raise ValueError(f"event_zone must be a fixed offset such as +02:00, not {self.event_zone!r}")

    def with_(self, **changes) -> PipelineConfig:
        return replace(self, **changes)


DEFAULT = PipelineConfig()
