"""Sub-index rule sets expressed as data.

A profile is a list of linear segments plus the rules for what happens at the
edges (NULL, negative, NaN, above the top, gaps, rounding).  The five rule sets
found in the original scripts are all expressed here; ``subindex`` compiles any
of them into a single native CASE expression (Spark Column or SQL text).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES -- must equal the published rule tables for results to match.
# ---------------------------------------------------------------------------

# Index edges shared by every Vietnamese table (I_1 .. I_8).
VN_INDEX_EDGES = [0, 50, 100, 150, 200, 300, 400, 500]

# Vietnamese concentration edges, µg/m³ (QĐ-TCMT 2019), in natural order.
VN_CONC_EDGES = {
    "o3_1h": [0, 160, 200, 300, 400, 800, 1000, 1200],
    "o3_8h": [0, 100, 120, 170, 210, 400],
    "co": [0, 10000, 30000, 45000, 60000, 90000, 120000, 150000],
    "so2": [0, 125, 350, 550, 800, 1600, 2100, 2630],
    "no2": [0, 100, 200, 700, 1200, 2350, 3100, 3850],
    "pm10": [0, 50, 150, 250, 350, 420, 500, 600],
    "pm25": [0, 25, 50, 80, 150, 250, 350, 500],
}

# US EPA stepped tables: (C_low, C_high, I_low, I_high); gaps between rows.
EPA_SEGMENTS = {
    "pm25": [(0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150),
             (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 500.4, 301, 500)],
    "pm10": [(0, 54, 0, 50), (55, 154, 51, 100), (155, 254, 101, 150),
             (255, 354, 151, 200), (355, 424, 201, 300), (425, 604, 301, 500)],
    "o3": [(0, 54, 0, 50), (55, 70, 51, 100), (71, 85, 101, 150),
           (86, 105, 151, 200), (106, 200, 201, 300)],
    "no2": [(0, 53, 0, 50), (54, 100, 51, 100), (101, 360, 101, 150),
            (361, 649, 151, 200), (650, 1249, 201, 300), (1250, 2049, 301, 500)],
    "so2": [(0, 35, 0, 50), (36, 75, 51, 100), (76, 185, 101, 150),
            (186, 304, 151, 200), (305, 604, 201, 300), (605, 1004, 301, 500)],
    "co": [(0.0, 4.4, 0, 50), (4.5, 9.4, 51, 100), (9.5, 12.4, 101, 150),
           (12.5, 15.4, 151, 200), (15.5, 30.4, 201, 300), (30.5, 50.4, 301, 500)],
}

# Continuous EPA PM2.5 cascade used by the forecast notebook:
# (upper C, slope numerator, slope denominator, C offset, I offset);
# sub-index = (num / den) * (C - C offset) + I offset for the first C <= upper.
EPA_PM25_CASCADE = [
    (12.0, 50.0, 12.0, 0.0, 0.0),
    (35.4, 49.0, 23.4, 12.0, 51.0),
    (55.4, 49.0, 19.9, 35.4, 101.0),
    (150.4, 49.0, 94.9, 55.4, 151.0),
    (250.4, 99.0, 99.9, 150.4, 201.0),
    (350.4, 99.0, 99.9, 250.4, 301.0),
    (500.4, 99.0, 149.9, 350.4, 401.0),
]
EPA_PM25_TOP_VALUE = 500.0

# ---------------------------------------------------------------------------

POLLUTANTS = ("o3_1h", "o3_8h", "co", "so2", "no2", "pm10", "pm25")


@dataclass(frozen=True)
class Segment:
    lo: float
    hi: float
    ilo: float
    ihi: float

    @property
    def slope(self) -> float:
        # same evaluation order as the rule: (I_hi - I_lo) / (BP_hi - BP_lo)
        return (self.ihi - self.ilo) / (self.hi - self.lo)


@dataclass(frozen=True)
class Profile:
    """Edge behaviour of one rule set.

    closed    : "both" -> lo <= c <= hi ; "left" -> lo <= c < hi
    null      : value for NULL input (None keeps NULL = row dropped / unknown)
    zero      : value for exactly 0 when the rule treats 0 as "no data"
    negative  : value for c < 0; "segments" lets negatives fall to the table
    above     : value when no segment matches (None = NULL)
    rounding  : "int" (half-even to integer), "float" (half-even, double), None
    """

    name: str
    closed: str = "both"
    null: float | None = 0
    zero: float | None = None
    negative: float | str | None = 0
    above: float | None = 500
    rounding: str | None = "int"
    pollutants: tuple = field(default=POLLUTANTS)


def vn_segments(pollutant: str) -> list[Segment]:
    edges = VN_CONC_EDGES[pollutant]
    idx = VN_INDEX_EDGES
    return [Segment(edges[i], edges[i + 1], idx[i], idx[i + 1]) for i in range(len(edges) - 1)]


def epa_segments(pollutant: str) -> list[Segment]:
    key = {"o3_1h": "o3", "o3_8h": "o3"}.get(pollutant, pollutant)
    return [Segment(*row) for row in EPA_SEGMENTS[key]]


PROFILES = {
    # live streaming job: NULL/negative -> 0, above -> 500, round half-even
    "vn_stream": Profile("vn_stream"),
    # same rule, missing stays missing (our default for new analyses)
    "vn": Profile("vn", null=None),
    # vectorised pandas job: no NULL/negative guard -> 500, float result
    "vn_batch": Profile("vn_batch", null=500, negative="segments", rounding="float"),
    # warehouse bracket join: half-open, unrounded, out of range dropped
    "vn_warehouse": Profile("vn_warehouse", closed="left", null=None, negative=None,
                            above=None, rounding=None),
    # older streaming job with US EPA tables: 0 is "no data", gaps -> 500
    "epa_stepped": Profile("epa_stepped", null=0, zero=0,
                           pollutants=("o3_1h", "co", "so2", "no2", "pm10", "pm25")),
    # forecast notebook: continuous PM2.5 cascade, unrounded
    "epa_pm25": Profile("epa_pm25", null=None, negative="segments", rounding=None,
                        pollutants=("pm25",)),
}


def segments_for(profile: str, pollutant: str) -> list[Segment]:
    if profile.startswith("epa_stepped"):
        return epa_segments(pollutant)
    return vn_segments(pollutant)
