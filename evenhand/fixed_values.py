"""Fixed values that results depend on: lookup tables, thresholds and label cut-offs.

Everything here is data. The operators take these as defaults and accept others.
"""

from __future__ import annotations

from dataclasses import dataclass

# Zone boxes in match order (the first box that holds a point wins).
# latitude from, latitude to, longitude from, longitude to, postal code, borough, neighbourhood
ZONE_BOXES = """
40.700,40.715,-74.020,-74.000,10004,Manhattan,Financial District
40.700,40.715,-74.000,-73.980,10038,Manhattan,City Hall
40.715,40.725,-74.015,-74.000,10013,Manhattan,Tribeca
40.715,40.725,-74.000,-73.990,10012,Manhattan,SoHo
40.715,40.725,-73.990,-73.975,10002,Manhattan,Lower East Side
40.725,40.740,-74.010,-74.000,10014,Manhattan,West Village
40.725,40.740,-74.000,-73.990,10003,Manhattan,Greenwich Village
40.725,40.740,-73.990,-73.975,10009,Manhattan,East Village
40.740,40.750,-74.005,-73.995,10011,Manhattan,Chelsea
40.740,40.750,-73.995,-73.980,10010,Manhattan,Gramercy Park
40.740,40.750,-73.980,-73.970,10016,Manhattan,Murray Hill
40.750,40.760,-74.000,-73.990,10001,Manhattan,Penn Station
40.750,40.760,-73.990,-73.980,10018,Manhattan,Garment District
40.750,40.760,-73.980,-73.970,10017,Manhattan,Grand Central
40.750,40.760,-73.970,-73.960,10022,Manhattan,Midtown East
40.760,40.770,-73.995,-73.985,10036,Manhattan,Times Square
40.760,40.770,-73.985,-73.975,10019,Manhattan,Midtown West
40.760,40.770,-73.975,-73.965,10020,Manhattan,Rockefeller Center
40.760,40.770,-73.965,-73.955,10065,Manhattan,Lenox Hill
40.770,40.785,-73.985,-73.970,10023,Manhattan,Upper West Side
40.770,40.785,-73.970,-73.955,10021,Manhattan,Upper East Side
40.785,40.800,-73.980,-73.965,10024,Manhattan,UWS North
40.785,40.800,-73.965,-73.945,10028,Manhattan,Yorkville
40.800,40.815,-73.975,-73.958,10025,Manhattan,Morningside Hts
40.800,40.815,-73.958,-73.940,10029,Manhattan,East Harlem
40.815,40.830,-73.960,-73.940,10027,Manhattan,Harlem
40.815,40.830,-73.940,-73.925,10035,Manhattan,East Harlem N
40.830,40.850,-73.955,-73.935,10031,Manhattan,Hamilton Heights
40.850,40.870,-73.940,-73.920,10032,Manhattan,Washington Hts
40.870,40.885,-73.930,-73.910,10034,Manhattan,Inwood
40.685,40.700,-74.000,-73.980,11201,Brooklyn,Brooklyn Heights
40.685,40.700,-73.980,-73.960,11205,Brooklyn,Fort Greene
40.700,40.720,-73.965,-73.945,11211,Brooklyn,Williamsburg
40.700,40.715,-73.945,-73.925,11206,Brooklyn,East Williamsburg
40.720,40.735,-73.960,-73.940,11222,Brooklyn,Greenpoint
40.690,40.700,-73.960,-73.940,11238,Brooklyn,Prospect Heights
40.670,40.690,-73.995,-73.975,11217,Brooklyn,Park Slope
40.655,40.670,-73.995,-73.975,11215,Brooklyn,South Slope
40.680,40.695,-73.955,-73.930,11216,Brooklyn,Bed-Stuy
40.665,40.680,-73.960,-73.935,11225,Brooklyn,Crown Heights
40.645,40.665,-73.965,-73.945,11226,Brooklyn,Flatbush
40.640,40.660,-74.020,-73.995,11220,Brooklyn,Sunset Park
40.620,40.640,-73.990,-73.965,11218,Brooklyn,Kensington
40.660,40.680,-73.930,-73.905,11233,Brooklyn,Ocean Hill
40.660,40.680,-73.910,-73.885,11207,Brooklyn,East New York
40.570,40.600,-73.995,-73.970,11224,Brooklyn,Coney Island
40.630,40.650,-74.010,-73.985,11232,Brooklyn,Industry City
40.675,40.695,-74.005,-73.985,11231,Brooklyn,Red Hook
40.740,40.760,-73.940,-73.915,11101,Queens,Long Island City
40.760,40.780,-73.930,-73.905,11106,Queens,Astoria
40.740,40.755,-73.915,-73.895,11104,Queens,Sunnyside
40.740,40.755,-73.895,-73.870,11377,Queens,Woodside
40.750,40.770,-73.870,-73.845,11372,Queens,Jackson Heights
40.730,40.745,-73.890,-73.865,11373,Queens,Elmhurst
40.745,40.765,-73.845,-73.815,11368,Queens,Corona
40.760,40.780,-73.835,-73.810,11354,Queens,Flushing
40.715,40.735,-73.870,-73.845,11374,Queens,Rego Park
40.715,40.735,-73.850,-73.825,11375,Queens,Forest Hills
40.700,40.720,-73.810,-73.785,11432,Queens,Jamaica
40.665,40.685,-73.850,-73.815,11414,Queens,Howard Beach
40.640,40.665,-73.800,-73.760,11430,Queens,JFK Airport
40.810,40.830,-73.930,-73.905,10451,Bronx,South Bronx
40.820,40.840,-73.925,-73.900,10454,Bronx,Mott Haven
40.830,40.855,-73.920,-73.895,10456,Bronx,Morrisania
40.840,40.860,-73.905,-73.880,10459,Bronx,Longwood
40.855,40.875,-73.910,-73.885,10457,Bronx,Tremont
40.860,40.880,-73.895,-73.870,10460,Bronx,West Farms
40.875,40.895,-73.895,-73.860,10458,Bronx,Fordham
40.840,40.860,-73.860,-73.830,10462,Bronx,Parkchester
40.880,40.910,-73.910,-73.890,10463,Bronx,Riverdale
40.625,40.650,-74.100,-74.070,10301,Staten Island,St. George
40.580,40.625,-74.180,-74.130,10314,Staten Island,Willowbrook
"""

# Borough boxes in match order, edges included.
# borough, latitude from, latitude to, longitude from, longitude to
BOROUGH_BOXES = """
Staten Island,40.496,40.651,-74.255,-74.052
Bronx,40.800,40.917,-73.933,-73.748
Manhattan,40.700,40.882,-74.019,-73.934
Brooklyn,40.570,40.739,-74.042,-73.860
Queens,40.530,40.812,-73.935,-73.700
"""


@dataclass(frozen=True)
class TripLimits:
    """What counts as a plausible trip. ``None`` switches a limit off."""

    fare: tuple[float, float] = (2.5, 500.0)
    max_distance: float = 100.0
    max_minutes: float | None = 300.0
    max_mph: float | None = 100.0
    max_passengers: int | None = 9
    lat: tuple[float, float] = (40.49, 40.92)
    lon: tuple[float, float] = (-74.27, -73.68)
    check_dropoff: bool = True


# The exploratory variant, which looks at fare, distance and a wider pickup box only.
WIDE_BOX_LIMITS = TripLimits(
    max_minutes=None,
    max_mph=None,
    max_passengers=None,
    lat=(40.4, 41.0),
    lon=(-74.5, -73.5),
    check_dropoff=False,
)

# Income bands, the income assumed for areas without one, and yearly volume.
HIGH_INCOME = 75000.0
MEDIUM_INCOME = 45000.0
DEFAULT_INCOME = 60000.0
INCOME_CLIP = (15000.0, 200000.0)
ANNUAL_TRIPS = 165_000_000
RUPEES_PER_DOLLAR = 83.0
INCOME_ORDER = ("low", "medium", "high")

# Score below the first cut is GOOD, below the second MODERATE, else POOR.
PARITY_CUTS = (0.5, 1.5)
ODDS_CUTS = (0.3, 1.0)
INDIVIDUAL_CUTS = (1.0, 3.0)

# Absolute effect size above which it is called medium and large.
EFFECT_CUTS = (0.5, 0.8)

# Forest settings and the two feature sets, the second without income.
FOREST = {"numTrees": 50, "maxDepth": 8, "seed": 42}
FAIR_FEATURES = (
    "trip_distance",
    "trip_duration_minutes",
    "passenger_count",
    "hour_of_day",
    "day_of_week",
    "is_rush_hour",
    "is_weekend",
    "is_night",
)
BASELINE_FEATURES = FAIR_FEATURES + ("median_income",)
SIMPLE_FEATURES = FAIR_FEATURES[:5]


def zone_rows() -> list[tuple]:
    """Zone boxes as ``(priority, lat_from, lat_to, lon_from, lon_to, zip, borough, neighborhood)``."""
    rows = []
    for priority, line in enumerate(ZONE_BOXES.split("\n")[1:-1]):
        *edges, code, borough, name = line.split(",")
        rows.append((priority, *map(float, edges), code, borough, name))
    return rows


def borough_rows() -> list[tuple]:
    """Borough boxes as ``(priority, lat_from, lat_to, lon_from, lon_to, borough)``."""
    rows = []
    for priority, line in enumerate(BOROUGH_BOXES.split("\n")[1:-1]):
        name, *edges = line.split(",")
        rows.append((priority, *map(float, edges), name))
    return rows
