"""Values that have to be spelled exactly like this for results to be comparable.

They are data, not logic: header spellings found on result sheets, categories on
registration exports, texts that appear in published tables, and model settings.
"""

# --- fixed values: result sheets -------------------------------------------------
SHEET_HEADERS = {
    "name_raw": ["Name", "Skier Name"],
    "time_raw": ["Race Time", "Elapsed"],
    "usss_id": ["USSS#", "Member #"],
    "fis_id": ["FIS#"],
    "school_raw": ["School"],
    "team_raw": ["Team"],
    "state_raw": ["State"],
}
SHEET_PREFIX = "prep_results"
SHEET_EDIT_URL = ("https://docs.google.com/spreadsheets/d/", "/edit")
SHEET_CSV_URL = ("https://docs.google.com/spreadsheets/d/", "/gviz/tq?tqx=out:csv")

# --- fixed values: genders, techniques, series ---------------------------------
GENDERS = ["b", "g"]
GENDER_CODES = {"m": "b", "f": "g"}
TECHNIQUES = ["CL", "SK"]
QUALIFIER_SERIES = "MAQ"
UNTOUCHED_NAME_SERIES = "EC"
UNIDENTIFIED_ATHLETE = "Unidentified Athlete"

# --- fixed values: registrations ------------------------------------------------
ELIGIBLE_CATEGORIES = [
    "U16/EHS Qualifer - Boys",
    "U16/EHS Qualifier - Girls",
    "Late U16/EHS Mass Nordic Cup - Boys",
    "Late U16/EHS Mass Nordic Cup - Boys UNSEEDED",
    "Late U16/EHS Mass Nordic Cup - Girls",
    "Late U16/EHS Mass Nordic Cup - Girls UNSEEDED",
]
GHOST_CATEGORY = "GHOST"
CLUBS_MEANING_NONE = [
    "I am not currently a member of a listed team or club",
    "My Team / Club is not listed.",
    "",
]
CLUB_SPELLINGS = {"Eastern Mass Nordic, inc (EMXC)": "EMXC"}
GRADE_NUMBERS = [7, 8, 9, 10, 11, 12]
GRADE_WORDS = {
    "freshman": 9,
    "firstyear": 9,
    "sophomore": 10,
    "junior": 11,
    "senior": 12,
}
EHS_GRADES = [9, 10, 11, 12]
U16_AGES = [14, 15]

# --- fixed values: points -------------------------------------------------------
VINTAGES = ["25", "26"]
PODIUM_SIZE = {"25": 5, "26": 6}
MIN_PENALTIED_FINISHERS = 3
FIRST_PUBLISHED_SEASON = 2026
NO_POINTS_REASONS = {
    "not_scored": "Race is not scored for points",
    "no_time": "Racer has no finish time (e.g., DNS/DNF/DQ)",
    "not_eligible": "Racer is not eligible for points",
    "unscorable": "Race is unscorable",
    "other": "No points earned: other reason",
}
QUALIFIER_SLOT = "1. MA Nordic Cup"
OTHER_SLOTS = [
    "2. First Best Points Race (if better than MA Nordic Cup points)",
    "3. Second Best Points Race (if better than MA Nordic Cup points)",
    "4. Third Best Points Race (if better than MA Nordic Cup points)",
]

# --- fixed values: penalty model ------------------------------------------------
TARGET_MEAN = 200.0
ROBUST_PERCENTILES = (0.25, 0.75)
OUTLIER_MIN_RACES = 5
OUTLIER_SIGMA = 2.0
STALENESS_MONTHS = 3

# Columns of the published tables.
WINDOW_COLUMNS = [
    "penalty_list_season",
    "penalty_list_date",
    "race_id",
    "race_date",
    "gender",
    "athlete_id",
    "athlete_name",
    "series",
    "reference_athlete_id",
    "time_float",
    "log_time",
    "time_log_ratio",
    "days_from_race_to_publication",
]
ATHLETE_ATTRIBUTES = [
    "athlete_name",
    "school",
    "club",
    "city_town",
    "state",
    "usss_age",
    "grade",
    "is_ehs_eligible",
    "is_u16c_eligible",
]
