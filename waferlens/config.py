"""Parameters shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

# Defaults every run starts from.
DEFAULT_SENTINEL = -200.0
DEFAULT_MAX_NULL_FRACTION = 0.35
DEFAULT_TOP_SENSORS = 50
DEFAULT_STATUS_BY_LABEL = {1: "pass", -1: "fail"}
DEFAULT_FAIL_BY_LABEL = {1: 0, -1: 1}
UNKNOWN_STATUS = "unknown"
FEATURE_PREFIX = "feature_"


@dataclass(frozen=True)
class PipelineConfig:
    """Everything a run may tune; column names stay arguments of the operators."""

    sentinel: float = DEFAULT_SENTINEL
    max_null_fraction: float = DEFAULT_MAX_NULL_FRACTION
    top_sensors: int = DEFAULT_TOP_SENSORS
    strict_null_filter: bool = False
    status_by_label: dict[int, str] = field(
        default_factory=lambda: dict(DEFAULT_STATUS_BY_LABEL)
    )
    fail_by_label: dict[int, int] = field(default_factory=lambda: dict(DEFAULT_FAIL_BY_LABEL))
    unknown_as_pass: bool = True

    @property
    def feature_names(self) -> list[str]:
        return feature_names(self.top_sensors)


def feature_names(count: int) -> list[str]:
    """``feature_001`` ... for ranks 1..count."""
    return [f"{FEATURE_PREFIX}{rank:03d}" for rank in range(1, count + 1)]


def sensor_names(count: int) -> list[str]:
    """``sensor_001`` ... for channels 1..count."""
    return [f"sensor_{channel:03d}" for channel in range(1, count + 1)]
