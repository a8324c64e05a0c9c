"""Job parameters.

Every threshold is a plain field, so a job can override one value with
``dataclasses.replace``. ``Settings.from_env`` reads the environment names an
existing deployment already exports.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

# Environment names an existing deployment sets -> our field.
ENV_NAMES = {
    "BRUTE_FORCE_ATTEMPT_THRESHOLD": ("brute_force_threshold", int),
    "BRUTE_FORCE_WINDOW_MINUTES": ("brute_force_minutes", int),
    "IMPOSSIBLE_TRAVEL_MAX_KMH": ("max_travel_kmh", float),
    "UNUSUAL_HOUR_START": ("business_start_hour", int),
    "UNUSUAL_HOUR_END": ("business_end_hour", int),
    "MULTI_FAIL_THRESHOLD": ("multi_fail_threshold", int),
    "MULTI_FAIL_WINDOW_MINUTES": ("multi_fail_minutes", int),
    "ISOLATION_FOREST_CONTAMINATION": ("contamination", float),
    "SPLUNK_INDEX": ("export_index", str),
}


@dataclass(frozen=True)
class Settings:
    # detection thresholds
    brute_force_threshold: int = 5
    brute_force_minutes: int = 5
    max_travel_kmh: float = 900.0
    business_start_hour: int = 6
    business_end_hour: int = 22
    multi_fail_threshold: int = 10
    multi_fail_minutes: int = 60

    # anomaly model
    contamination: float = 0.05
    forest_trees: int = 200
    forest_sample: int = 256
    forest_min_rows: int = 10
    seed: int = 42

    # export
    export_index: str = "siem"

    # execution: a key with more rows than this is split over several tasks
    max_rows_per_task: int = 5_000_000
    # execution: a side is broadcast only after it was counted to be within this
    max_broadcast_rows: int = 200_000

    def __post_init__(self):
        for name in ("brute_force_threshold", "multi_fail_threshold", "forest_trees",
                     "forest_sample", "max_rows_per_task"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if not 0 < self.contamination <= 0.5:
            raise ValueError("contamination must be in (0, 0.5]")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> "Settings":
        env = os.environ if env is None else env
        return cls(**{field: cast(env[name])
                      for name, (field, cast) in ENV_NAMES.items() if name in env})
