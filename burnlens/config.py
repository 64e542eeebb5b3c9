"""Constants, segment definitions and column lists.

Everything a pipeline stage needs to know about *which* columns mean what lives
here, so the operators stay column-parameterised.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values (must equal the reference's for equal results) -------------
# Emission factor kg CO2 per kg fuel; fuel price EUR/kg; carry penalty share;
# EU ETS EUR per tonne CO2; annual flight count used to annualise; minimum
# segment size; anomaly z threshold; cruise speed for the distance fallback;
# earth radius km; planning-gap threshold kg; data-issue burn / distance
# floors; data-issue abs-error quantile; route persistence rate; monitor
# persistence rate; confidence ramp (flights); trained-set mean target (drift).
CO2_PER_KG_FUEL = 3.16
FUEL_PRICE_PER_KG = 0.80
FUEL_CARRY_PENALTY = 0.035
ETS_PRICE_PER_TONNE = 70.0
ANNUAL_FLIGHTS = 550_000
MIN_SEGMENT_SIZE = 8
ANOMALY_Z = 2.5
CRUISE_KMH = 750.0
EARTH_RADIUS_KM = 6371.0
PLANNING_GAP_KG = 500.0
DATA_ISSUE_MIN_BURN = 500.0
DATA_ISSUE_MIN_KM = 100.0
DATA_ISSUE_QUANTILE = 0.995
PERSISTENT_RATE = 0.60
MONITOR_PERSISTENT_RATE = 0.12
CONFIDENCE_FLIGHTS = 25.0
REFERENCE_MEAN_TARGET = 4619.0
DRIFT_TOLERANCE = 0.20
BUFFER_Z = 1.65
STABILITY_EPS = 1e-9
WHAT_IF_MIN_ROWS = 5
WHAT_IF_KG_PER_LOAD = 3000.0
WHAT_IF_FLOOR_KG = 500.0

# Aircraft-type multipliers (default 1 for anything else).
TYPE_FACTORS = {"NG": 1.0, "Max": 2.0, "Airbus": 1.5}

# Decimals of the exact totals of money, CO2 and fuel.
FIXED_PLACES = 4

# Driver data: part types that stand for the named aircraft families.
TYPE_NAMES = {"ECONOMY": "NG", "LARGE": "Max", "MEDIUM": "Airbus"}

# Fixed values (labels and edges appear in the results): season by departure month.
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}
SEASON_ORDER = ["Winter", "Spring", "Summer", "Fall"]

# Departure hour bands (inclusive hour ranges); everything else is night.
HOUR_BANDS = [
    ("Morning Peak", 5, 8),
    ("Late Morning", 9, 12),
    ("Afternoon", 13, 16),
    ("Evening Peak", 17, 20),
]
NIGHT_BAND = "Night / Early"
UNKNOWN = "Unknown"

# Load-factor bands, label for x < upper bound; last label for the rest.
LOAD_BANDS = [("<60%", 0.60), ("60-75%", 0.75), ("75-85%", 0.85), ("85-95%", 0.95)]
LOAD_BAND_TOP = "95-100%"

# Distance bands, label for x < upper bound; last label for the rest.
DISTANCE_BANDS = [
    ("Short (<800 km)", 800.0),
    ("Medium (800-1500 km)", 1500.0),
    ("Long (1500-2500 km)", 2500.0),
]
DISTANCE_BAND_TOP = "Ultra-long (>2500 km)"

# Dashboard fallback bands, right-closed edges (pd.cut style).
FALLBACK_HOUR_EDGES = [-1, 8, 12, 16, 20, 24]
FALLBACK_HOUR_LABELS = ["Morning Peak", "Late Morning", "Afternoon", "Evening Peak", "Night / Early"]
FALLBACK_LOAD_EDGES = [-0.01, 0.6, 0.75, 0.85, 0.95, 1.0]
FALLBACK_LOAD_LABELS = ["<60%", "60-75%", "75-85%", "85-95%", "95-100%"]
FALLBACK_DIST_EDGES = [-1, 800, 1500, 2500, float("inf")]
FALLBACK_DIST_LABELS = ["Short (<800 km)", "Medium (800-1500 km)", "Long (1500-2500 km)", "Ultra-long (>2500 km)"]

# Segment separator for composite names.
SEGMENT_SEP = " | "

# Fixed values (names appear in the results): segment definitions, in their order of evaluation.
Z_SPECS = [
    ("Route × Aircraft", ["ScheduledRoute", "AircraftTypeGroup"]),
    ("Route", ["ScheduledRoute"]),
    ("Aircraft", ["AircraftTypeGroup"]),
    ("Airport × Hour", ["Origin", "DepartureHourBand"]),
    ("Season", ["Season"]),
]
SEGMENT_SPECS = [
    ("Route", ["ScheduledRoute"]),
    ("Aircraft", ["AircraftTypeGroup"]),
    ("Carrier", ["Carrier"]),
    ("Origin", ["Origin"]),
    ("Destination", ["Destination"]),
    ("Season", ["Season"]),
    ("Departure Hour", ["DepartureHourBand"]),
    ("Load Factor Band", ["LoadFactorBand"]),
    ("Distance Band", ["DistanceBand"]),
    ("Route × Aircraft", ["ScheduledRoute", "AircraftTypeGroup"]),
    ("Airport × Hour", ["Origin", "DepartureHourBand"]),
]
MONITOR_SPECS = [
    ("Route", ["ScheduledRoute"]),
    ("Aircraft", ["AircraftTypeGroup"]),
    ("Airport × Hour", ["Origin", "DepartureHourBand"]),
    ("Route × Aircraft", ["ScheduledRoute", "AircraftTypeGroup"]),
    ("Season", ["Season"]),
]
SCENARIO_SEGMENT_TYPES = ["Route", "Aircraft", "Airport × Hour", "Route × Aircraft"]
SCENARIOS = [
    ("Reduce excess burn by 25%", 0.25),
    ("Reduce excess burn by 50%", 0.50),
]
PEER_SCENARIO = "Move to peer median"

# Fixed values (the model and its tables must have these columns): model features,
# columns of the VIF and correlation tables, ridge penalties, split, folds and seed.
TARGET = "Burnoff"
NUMERIC_FEATURES = [
    "PlannedTripTime", "PlannedTOW", "PlannedZeroFuelWeight", "TeledyneRampWeight",
    "BlockTimeScheduled", "RouteDistanceKm", "LoadFactor", "TotalPassengers",
    "WeightDelta", "TypeWeightInteraction", "TypeTripTimeInteraction",
    "DepartureHour", "DepartureMonth", "DepartureDayOfWeek", "Freight",
]
CATEGORICAL_FEATURES = ["AircraftTypeGroup", "Carrier", "AOCDescription", "Season"]
VIF_COLUMNS = [
    "PlannedTripTime", "PlannedTOW", "PlannedZeroFuelWeight", "TeledyneRampWeight",
    "BlockTimeScheduled", "RouteDistanceKm", "LoadFactor", "TotalPassengers",
    "WeightDelta", "TypeWeightInteraction", "TypeTripTimeInteraction",
]
CORR_COLUMNS = [
    "Burnoff", "PlannedTripTime", "PlannedTOW", "PlannedZeroFuelWeight",
    "TeledyneRampWeight", "RouteDistanceKm", "LoadFactor", "TotalPassengers",
    "BlockTimeScheduled", "WeightDelta",
]
RIDGE_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0, 1000.0, 5000.0]
SPLIT_VALIDATION_PCT = 20
N_FOLDS = 5
SEED = 42


@dataclass(frozen=True)
class Economics:
    """Money / emission parameters; defaults are the reference's constants."""

    co2_per_kg: float = CO2_PER_KG_FUEL
    price_per_kg: float = FUEL_PRICE_PER_KG
    carry_penalty: float = FUEL_CARRY_PENALTY
    ets_per_tonne: float = ETS_PRICE_PER_TONNE
    annual_flights: int = ANNUAL_FLIGHTS


@dataclass(frozen=True)
class AnomalyRules:
    z: float = ANOMALY_Z
    min_segment: int = MIN_SEGMENT_SIZE
    quantile: float = DATA_ISSUE_QUANTILE
    min_burn: float = DATA_ISSUE_MIN_BURN
    min_km: float = DATA_ISSUE_MIN_KM
    planning_gap: float = PLANNING_GAP_KG
    z_specs: list = field(default_factory=lambda: list(Z_SPECS))
