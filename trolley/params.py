"""Parameters and fixed values.

Fixed values below must equal the study's own figures for results to agree;
they are stated plainly and together.  Everything data-dependent (thresholds
on the driver's tables) is a parameter with a default chosen for those tables.
"""

from __future__ import annotations

# --- fixed values (study definitions) -------------------------------------
# Basket segments: value < SMALL_BELOW -> Small, value <= MEDIUM_UP_TO -> Medium, else Large.
STUDY_SEGMENT_EDGES = (500.0, 2000.0)
SEGMENT_LABELS = ("Small", "Medium", "Large")
# Festival-season months and the weekend weekday (ISO, 6 = Saturday).
SEASON_MONTHS = (9, 10)
WEEKEND_ISO_DAY = 6
# Season label of a calendar month for stock planning; other months are "Regular".
MONTH_SEASON = {
    7: "Monsoon", 8: "Monsoon", 9: "Festival Season",
    10: "Festival Season", 11: "Winter", 12: "Winter",
    1: "Winter", 2: "Spring", 3: "Spring",
    4: "Spring", 5: "Pre-Summer",
}
DEFAULT_SEASON = "Regular"
# The five placement zones: (zone number, assignment, label, location, intention class).
ZONES = (
    (1, "Zone 1 - Center", "Anchor Cluster", "Store Center", "assists"),
    (2, "Zone 2 - Entrance", "Impulse Purchase", "Near Entrance", "creates"),
    (3, "Zone 3 - Side Aisle", "Destination", "Side Aisle", "assists"),
    (4, "Zone 4 - Back Wall", "Cold Storage", "Back Wall", "assists"),
    (5, "Zone 5 - Perimeter", "Speciality", "Perimeter", "assists"),
)
ZONE_SIZES = (6, 5, 3, 4, 7)
# ABC classes by cumulative revenue share (percent).
ABC_EDGES = (70.0, 90.0)
# Mining defaults of the study.
MIN_SUPPORT_CATEGORY = 0.01
MIN_SUPPORT_PRODUCT = 0.005
STRONG_LIFT = 3.0
HIST_BINS = 40
HIST_CAP_STUDY = 5000.0
UPLIFT_SCENARIOS = (3.0, 5.0, 8.0)
SIMILARITY_FLOOR = 0.72

# --- parameters for the driver's tables (see FIXTURES.md) ------------------
SEGMENT_EDGES = (150000.0, 300000.0)
HIST_CAP = 500000.0
STRONG_LIFT_TEST = 1.02
VALIDATION_FROM = "1999-01-01"
