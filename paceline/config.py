"""Settings, circuits and validation policies, as plain records; YAML files override them where PyYAML is installed."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class Circuit:
    # Fixed values of the one circuit that is described.
    track_length_m: float = 3700.0
    reference_lap_time_sec: float = 95.0
    min_lap_time_sec: float = 85.0
    max_lap_time_sec: float = 180.0
    lat_min: float = 33.50
    lat_max: float = 33.60
    lon_min: float = -86.65
    lon_max: float = -86.55


@dataclass(frozen=True)
class Policy:
    """Thresholds of validation. Ranges: signal to (least, severity below, most, severity above)."""

    ranges: dict = field(
        default_factory=lambda: {
            "speed": (0.0, "FAIL", None, "WARN"),
            "aps": (0.0, "FAIL", 1.0, "FAIL"),
            "gear": (-1.0, "FAIL", 10.0, "FAIL"),
            "pbrake_f": (0.0, "FAIL", None, "WARN"),
            "pbrake_r": (0.0, "FAIL", None, "WARN"),
            "nmot": (0.0, "WARN", 9000.0, "WARN"),
        }
    )
    nan_warn_pct: float = 1.0
    nan_fail_pct: float = 5.0
    critical: tuple = ("speed", "Steering_Angle", "aps", "gear", "lap")
    drift_warn_std: float = 10.0
    drift_fail_std: float = 30.0
    gap_warn_sec: float = 0.5
    gap_fail_sec: float = 2.0
    position_missing_fail_pct: float = 10.0
    gps_jump_m: float = 500.0
    min_cars: int = 3
    min_duration_sec: float = 1800.0
    min_coverage_pct: float = 10.0
    min_lap_count: int = 10
    lap_sentinel_fail_pct: float = 10.0


@dataclass(frozen=True)
class Settings:
    freq_hz: float = 20.0
    gap_sec: float = 2.0
    backwards_tolerance_sec: float = 0.001
    drift_window_minutes: int = 5
    spike_threshold: float = 3.0
    ffill_limit_sec: float = 0.2
    circuit: Circuit = field(default_factory=Circuit)
    policy: Policy = field(default_factory=Policy)


CIRCUITS = {"barber": Circuit()}


def circuit(name: str) -> Circuit:
    if name not in CIRCUITS:
        raise ValueError(f"unknown circuit: {name}")
    return CIRCUITS[name]


def from_yaml(path: str, kind: type):
    """A record of `kind` with the values of a YAML file in place of its own."""
    import yaml

    with open(path) as f:
        given = yaml.safe_load(f) or {}
    return replace(kind(), **{k: v for k, v in given.items() if k in {x.name for x in fields(kind)}})
