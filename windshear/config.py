"""Parameters of one hub analysis.

Everything the original job hard-coded (hub code, hub time zone, grid step,
wind bins, runway limits, word lists) is a field here, so the same operators
serve any hub.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference application's values for the
# results to agree; they are stated here once, in their natural order.
# ---------------------------------------------------------------------------

# Hub airport and its time zone.
REFERENCE_HUB = "ATL"
REFERENCE_HUB_TZ = "America/New_York"

# Weather grid step in seconds (5 minutes).
GRID_SECONDS = 300

# Wind-speed bin lower bounds in m/s and their labels in knots. The last bin is open.
WIND_BOUNDS = (0.0, 2.57, 5.14, 7.72, 10.29, 12.86, 15.43, 18.01)
WIND_LABELS = ("00-05", "05-10", "10-15", "15-20", "20-25", "25-30", "30-35", ">35")

# Weather conditions that count as a dry runway; anything else (or missing) is wet.
DRY_CONDITIONS = (
    "Clear",
    "Fog",
    "Mostly Clear",
    "Mostly Cloudy",
    "N/A",
    "Overcast",
    "Partly Cloudy",
    "Smoke",
)

# Wind directions that blow across the hub's east-west runways.
CROSSWIND_DIRECTIONS = ("NW", "NNW", "N", "NNE", "NE", "SE", "SSE", "S", "SSW", "SW")

# Crosswind limits in m/s: dry runway and wet runway.
DRY_LIMIT = 15.43
WET_LIMIT = 7.72

# The 16-point compass, in drawing order.
COMPASS = (
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
)

# Labels of the two interruption rows and the bin given to a zero-filled direction.
DELAY_ROW_LABEL = "weather delay by CW"
CANCEL_ROW_LABEL = "weather cancellation by CW"
ZERO_FILL_BIN = "00-05"

# Cancellation code that marks a weather cancellation.
WEATHER_CANCELLATION_CODE = "B"

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class HubConfig:
    """All knobs of one analysis; defaults reproduce the reference job."""

    hub: str = REFERENCE_HUB
    hub_tz: str = REFERENCE_HUB_TZ
    grid_seconds: int = GRID_SECONDS
    wind_bounds: tuple[float, ...] = WIND_BOUNDS
    wind_labels: tuple[str, ...] = WIND_LABELS
    dry_conditions: tuple[str, ...] = DRY_CONDITIONS
    crosswind_directions: tuple[str, ...] = CROSSWIND_DIRECTIONS
    dry_limit: float = DRY_LIMIT
    wet_limit: float = WET_LIMIT
    compass: tuple[str, ...] = COMPASS
    # D3: arrival past midnight stays on the flight date unless this is set.
    roll_overnight: bool = False
    # None keeps the weather fan-out of the original join; "latest" keeps
    # one observation per grid key.
    weather_dedupe: str | None = None
    # Also snap weather observations to the grid before joining.
    snap_weather: bool = False
    # Weather keys with more rows than this are split over salt buckets
    # (None: plain left join; then only flight-side skew is split, by AQE).
    hot_key_rows: int | None = 100_000
    salt_buckets: int = 16
    # Byte limit under which a join side is broadcast (checked on the plan).
    broadcast_limit: int = 64 * 1024 * 1024
    extra: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if len(self.wind_bounds) != len(self.wind_labels):
            raise ValueError("wind_bounds and wind_labels must have the same length")
        if list(self.wind_bounds) != sorted(self.wind_bounds):
            raise ValueError("wind_bounds must be ascending")
        if self.weather_dedupe not in (None, "latest"):
            raise ValueError(f"unknown weather_dedupe {self.weather_dedupe!r}")
        if self.grid_seconds <= 0 or 86400 % self.grid_seconds:
            raise ValueError("grid_seconds must divide a day")
