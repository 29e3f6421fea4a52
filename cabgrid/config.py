"""Parameters of the analysis."""

from __future__ import annotations

from dataclasses import dataclass, field

from cabgrid.functions.hexgrid import HexGrid


@dataclass(frozen=True)
class Box:
    """Closed latitude/longitude rectangle."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# Where weather is sampled, (place, latitude, longitude).
WEATHER_PLACES = [
    ("Manhattan", 40.7812, -73.9665),
    ("Queens", 40.7769, -73.8740),
    ("Brooklyn", 40.6782, -73.9442),
    ("Bronx", 40.8501, -73.8662),
    ("Staten Island", 40.5795, -74.1502),
    ("EWR", 40.6895, -74.1745),
]

# Stations kept, and points for which the service answers.
STATION_BOX = Box(40.45, 40.95, -74.30, -73.65)
SERVICE_BOX = Box(40.40, 40.95, -74.30, -73.65)

# Zone ids that stand for "unknown".
UNKNOWN_ZONES = (264, 265)


@dataclass(frozen=True)
class Weights:
    """Scoring weights (fixed values of the scoring formula)."""

    fast: float = 2.5
    level2: float = 1.0
    # discount of the first, second and third nearest station
    by_priority: tuple[float, ...] = (1.0, 0.6, 0.3)
    demand: float = 0.50
    distance: float = 0.25
    charger: float = 0.25
    # keeps min-max scaling defined when all values are equal
    epsilon: float = 1e-9


@dataclass(frozen=True)
class ModelConfig:
    """Demand model settings (fixed values of the published run)."""

    cutoff: str = "2025-06-01"
    trees: int = 40
    depth: int = 6
    seed: int = 17


@dataclass(frozen=True)
class Settings:
    grid: HexGrid = field(default_factory=HexGrid)
    window: str = "5 minutes"
    row_lags: tuple[int, ...] = (1, 12, 288)
    # How the model looks back: "rows" counts observed windows, "calendar" looks exactly so many
    # windows back, "dense" counts rows after windows without pickups are added.
    lag_kind: str = "rows"
    ring: int = 4
    stations_per_cell: int = 3
    top: int = 5
    station_box: Box = STATION_BOX
    service_box: Box = SERVICE_BOX
    unknown_zones: tuple[int, ...] = UNKNOWN_ZONES
    weights: Weights = field(default_factory=Weights)
    model: ModelConfig = field(default_factory=ModelConfig)
