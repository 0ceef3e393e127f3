"""Race-shaped views derived from the given tables.

One SQL text per view, valid in Spark and in DuckDB, so that a query and its check read the same
input. Nothing here is an operator of the library. Athletes are suppliers, races are a month with
its two line flags, minutes are prices / 1000; dates move 25 years on so that published seasons occur.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from .session import durable

VIEWS: dict[str, str] = {}

# One row per race and athlete. `lineitem` has no unique key, hence the aggregate.
VIEWS["race_times"] = """
SELECT concat('r', CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING), l_returnflag, l_linestatus) AS race_id,
  make_date(CAST(year(l_shipdate) + 25 AS INT), CAST(month(l_shipdate) AS INT), 1) AS race_date,
  CAST(year(l_shipdate) + 25 + CASE WHEN month(l_shipdate) >= 7 THEN 1 ELSE 0 END AS BIGINT) AS race_season,
  CASE concat(l_returnflag, l_linestatus) WHEN 'RO' THEN 'MAQ' WHEN 'NF' THEN 'EC'
    ELSE concat(l_returnflag, l_linestatus) END AS series,
  CAST(l_suppkey AS BIGINT) AS suppkey,
  CASE WHEN min(l_tax) >= 0.08 THEN NULL ELSE min(l_extendedprice) / 1000.0 END AS time_float
FROM lineitem GROUP BY 1, 2, 3, 4, 5"""

VIEWS["dim_results"] = """
SELECT concat(race_id, 'a', CAST(suppkey AS STRING)) AS result_id, race_id,
  concat('a', CAST(suppkey AS STRING)) AS athlete_id, race_date, race_season, series,
  CASE WHEN suppkey % 2 = 0 THEN 'b' ELSE 'g' END AS gender,
  concat('Skier ', CAST(suppkey AS STRING)) AS athlete_name,
  CAST(CAST(floor(time_float) AS BIGINT) AS STRING) AS time, time_float,
  CAST(suppkey % 50 + 1 AS BIGINT) AS finish_place
FROM race_times"""

VIEWS["dim_races"] = """
SELECT race_id, race_date, race_season, concat('Race ', race_id) AS race_name, series,
  CASE WHEN month(race_date) % 2 = 0 THEN 'CL' ELSE 'SK' END AS technique,
  CASE month(race_date) % 3 WHEN 0 THEN 'DI' WHEN 1 THEN 'SP' ELSE 'RL' END AS discipline,
  CASE WHEN month(race_date) < 6 THEN 'mass' ELSE 'interval' END AS race_format,
  concat('D', substr(race_id, 8, 1)) AS division, concat('Venue ', substr(race_id, 6, 2)) AS venue
FROM race_times GROUP BY race_id, race_date, race_season, series"""

# Every 11th athlete never registers, every 17th is a ghost.
VIEWS["dim_registrations"] = """
SELECT concat('a', CAST(suppkey AS STRING), '_', CAST(race_season AS STRING)) AS registration_id, race_season,
  concat('a', CAST(suppkey AS STRING)) AS athlete_id, concat('Skier ', CAST(suppkey AS STRING)) AS athlete_name,
  CASE WHEN suppkey % 2 = 0 THEN 'b' ELSE 'g' END AS gender, suppkey % 17 = 0 AS is_ghost_registration,
  CASE WHEN (suppkey + race_season) % 5 = 0 THEN NULL
    ELSE concat('School ', CAST((suppkey + race_season) % 13 AS STRING)) END AS school,
  CASE WHEN race_season % 3 = 0 THEN NULL ELSE concat('Club ', CAST(suppkey % 7 AS STRING)) END AS club,
  concat('Town ', CAST(suppkey % 19 AS STRING)) AS city_town, CASE WHEN suppkey % 4 = 0 THEN 'VT' ELSE 'MA' END AS state,
  CAST(CASE WHEN race_season % 2 = 0 THEN suppkey + 1000 END AS BIGINT) AS nensa_number,
  CAST(CASE WHEN race_season % 4 = 0 THEN suppkey + 5000 END AS BIGINT) AS usss_number,
  CAST(2010 - suppkey % 4 AS BIGINT) AS birth_year,
  CAST(CASE WHEN (suppkey + race_season) % 6 = 0 THEN NULL ELSE 7 + (suppkey + race_season) % 6 END AS BIGINT) AS grade,
  CAST(race_season - 1 - (2010 - suppkey % 4) AS BIGINT) AS usss_age,
  (suppkey + race_season) % 6 >= 2 AS is_ehs_eligible, suppkey % 3 <> 0 AS is_u16c_eligible
FROM race_times WHERE suppkey % 11 <> 0 GROUP BY suppkey, race_season"""

VIEWS["publications"] = """
SELECT DISTINCT race_date AS penalty_list_date, race_season AS penalty_list_season
FROM race_times WHERE month(race_date) IN (1, 7)"""

# Series RF has no window; the newest season replaces older ones for EC and MAQ.
VIEWS["contribution_windows"] = """
SELECT series, CAST(CASE series WHEN 'AF' THEN 52 WHEN 'AO' THEN 78 WHEN 'EC' THEN 104 WHEN 'NO' THEN 26 ELSE 60 END AS INT)
    AS contributing_window_weeks, series IN ('EC', 'MAQ') AS current_season_supplants_previous_season
FROM race_times WHERE series <> 'RF' GROUP BY series"""

VIEWS["point_series"] = """
SELECT series, CASE WHEN series = 'AO' THEN 'false' ELSE 'true' END AS is_point_generating,
  CAST(CASE WHEN series = 'AF' THEN NULL ELSE 0.9 END AS DOUBLE) AS compression_factor_di,
  CAST(CASE WHEN series = 'EC' THEN NULL ELSE 0.8 END AS DOUBLE) AS compression_factor_sp
FROM race_times WHERE series <> 'NO' GROUP BY series"""

# A penalty that SQL can express, so that points can be checked by value. Not the model.
VIEWS["stand_in_penalties"] = """
SELECT penalty_list_date, gender, athlete_id,
  CASE WHEN count(CASE WHEN recent THEN 1 END) > 0 THEN
    round(200 * exp(avg(CASE WHEN recent THEN e END)) * 100) / 100 END AS standardized_athlete_penalty_25,
  round(200 * exp(avg(e)) * 100) / 100 AS standardized_athlete_penalty_26
FROM (SELECT d.penalty_list_date, r.gender, r.athlete_id, r.race_season >= year(d.penalty_list_date) AS recent,
        ln(r.time_float) - m.mean_log AS e
      FROM dim_results r
      JOIN (SELECT race_id, gender, avg(ln(time_float)) AS mean_log FROM dim_results GROUP BY race_id, gender) m
        ON m.race_id = r.race_id AND m.gender = r.gender
      JOIN publications d ON r.race_date < d.penalty_list_date AND r.race_season >= year(d.penalty_list_date) - 1
      WHERE r.time_float IS NOT NULL) t
GROUP BY penalty_list_date, gender, athlete_id"""

# Messy names: hard spaces, doubled blanks, asterisks, apostrophes.
VIEWS["raw_names"] = """
SELECT c_custkey, c_name, c_mktsegment, c_nationkey,
  concat(CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE '' END, CASE WHEN c_custkey % 4 = 1 THEN 'o' ELSE 'mc' END,
    CASE WHEN c_custkey % 5 = 2 THEN '''' ELSE '-' END, lower(c_mktsegment), CASE WHEN c_custkey % 2 = 0 THEN chr(160) ELSE '   ' END,
    upper(c_mktsegment), '#', CAST(c_custkey AS STRING), 'th',
    CASE WHEN c_custkey % 7 = 3 THEN ' *' ELSE '' END, CASE WHEN c_custkey % 6 = 0 THEN chr(9) ELSE '' END) AS name_raw
FROM customer"""

VIEWS["raw_times"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  CASE l_linenumber % 7
    WHEN 0 THEN concat(CAST(l_partkey % 60 AS STRING), ':', CAST(l_suppkey % 60 AS STRING), '.', CAST(l_orderkey % 10 AS STRING))
    WHEN 1 THEN concat('1:', CAST(l_partkey % 60 AS STRING), ':', CAST(l_suppkey % 60 AS STRING))
    WHEN 2 THEN CAST(CAST(l_quantity AS INT) AS STRING)
    WHEN 3 THEN CASE WHEN l_orderkey % 2 = 0 THEN 'DNF' ELSE '' END
    WHEN 4 THEN concat('''', CAST(l_partkey % 60 AS STRING), ':', CAST(l_suppkey % 60 AS STRING), ' ')
    WHEN 5 THEN CASE WHEN l_orderkey % 3 = 0 THEN '1d' WHEN l_orderkey % 3 = 1 THEN 'NaN' ELSE '1:2:3:4' END
    ELSE NULL END AS time_raw
FROM lineitem"""

# Staged sheets: names of athletes in several spellings, times as text.
VIEWS["staged"] = """
SELECT concat(CASE WHEN suppkey % 23 = 5 THEN 'team bus' ELSE concat('o''skier', CASE WHEN length(race_id) % 2 = 0 THEN '  ' ELSE chr(160) END,
    'no ', CAST(suppkey AS STRING)) END, CASE WHEN suppkey % 5 = 0 THEN '*' ELSE '' END) AS name_raw,
  CASE WHEN time_float IS NULL THEN 'DNF' ELSE concat(CAST(CAST(floor(time_float) AS BIGINT) AS STRING), ':',
    CAST(CAST(floor((time_float - floor(time_float)) * 60) AS BIGINT) AS STRING), '.', CAST(suppkey % 10 AS STRING)) END AS time_raw,
  CAST(suppkey + 5000 AS STRING) AS usss_id, CAST(NULL AS STRING) AS fis_id,
  concat('school ', CAST(suppkey % 9 AS STRING)) AS school_raw, concat('team ', CAST(suppkey % 7 AS STRING)) AS team_raw, 'VT' AS state_raw,
  race_id, CASE WHEN suppkey % 2 = 0 THEN 'b' ELSE 'g' END AS gender, concat('f', race_id) AS source_file_id, concat('u', race_id) AS prep_results_url
FROM race_times"""

# Spellings: every 10th athlete is renamed, and one variant is listed twice (the later line wins).
VIEWS["name_spellings"] = """
SELECT concat('Renamed ', CAST(s_suppkey AS STRING)) AS canonical, concat('O''Skier No ', CAST(s_suppkey AS STRING)) AS variant,
  CAST(s_suppkey AS BIGINT) AS line FROM supplier WHERE s_suppkey % 10 = 3
UNION ALL SELECT 'Overruled' AS canonical, 'O''Skier No 3' AS variant, CAST(-1 AS BIGINT) AS line FROM supplier WHERE s_suppkey = 3"""

VIEWS["school_spellings"] = """
SELECT concat('Academy ', CAST(s_suppkey AS STRING)) AS canonical, concat('School ', CAST(s_suppkey AS STRING)) AS variant,
  CAST(s_suppkey AS BIGINT) AS line FROM supplier WHERE s_suppkey < 4"""

VIEWS["non_people"] = """
SELECT CASE WHEN s_suppkey = 1 THEN 'Team Bus' ELSE concat('Forerunner ', CAST(s_suppkey AS STRING)) END AS non_person
FROM supplier WHERE s_suppkey % 10 = 1"""

VIEWS["staged_registrations"] = """
SELECT CASE c_custkey % 9 WHEN 0 THEN 'U16/EHS Qualifer - Boys' WHEN 1 THEN ' U16/EHS Qualifier - Girls '
    WHEN 2 THEN 'Late U16/EHS Mass Nordic Cup - Boys' WHEN 3 THEN 'Late U16/EHS Mass Nordic Cup - Girls UNSEEDED'
    WHEN 4 THEN 'GHOST' WHEN 5 THEN ' GHOST' WHEN 6 THEN 'T-shirt' WHEN 7 THEN 'U16/EHS Qualifer - Boys' ELSE NULL END AS category,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE concat('o''', lower(c_mktsegment)) END AS first_name,
  concat('no', CAST(c_custkey AS STRING)) AS last_name, concat('new town ', CAST(c_nationkey AS STRING)) AS city, 'vt' AS state,
  CASE WHEN c_custkey % 3 = 0 THEN 'Other' WHEN c_custkey % 3 = 1 THEN concat('school ', CAST(c_custkey % 9 AS STRING)) END AS school,
  'the other school' AS school_oth,
  CASE c_nationkey % 5 WHEN 0 THEN 'My Team / Club is not listed.' WHEN 1 THEN '' WHEN 2 THEN 'Eastern Mass Nordic, inc (EMXC)' ELSE 'Club' END AS club,
  CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'f' END AS gender,
  CASE WHEN c_custkey % 4 = 0 THEN 'NO LICENSE' ELSE CAST(c_custkey AS STRING) END AS nensa,
  CASE WHEN c_custkey % 6 = 0 THEN 'INTERNATIONAL' ELSE CAST(c_custkey + 7 AS STRING) END AS usss,
  CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(2008 + c_custkey % 5 AS STRING) END AS birth_year,
  CASE c_custkey % 7 WHEN 0 THEN '10th' WHEN 1 THEN 'Freshman' WHEN 2 THEN 'first-year' WHEN 3 THEN '12' WHEN 4 THEN '2027'
    WHEN 5 THEN '' ELSE 'Senior!' END AS grade,
  CAST(2024 + c_custkey % 3 AS BIGINT) AS race_season
FROM customer"""

# Sheets of a season whose races have one result per athlete, the best of the season in the series.
VIEWS["season_sheets"] = """
SELECT concat('prep_results_', series, CAST(race_season AS STRING), CASE WHEN suppkey % 2 = 0 THEN '_b' ELSE '_g' END) AS sheet_name, series,
  concat('Skier ', CAST(suppkey AS STRING)) AS name, CASE WHEN min(time_float) IS NULL THEN 'DNF'
    ELSE concat(CAST(CAST(floor(min(time_float)) AS BIGINT) AS STRING), ':', CAST(CAST(floor((min(time_float) - floor(min(time_float))) * 60) AS BIGINT) AS STRING)) END AS time,
  CAST(suppkey + 5000 AS STRING) AS usss, concat('School, "', CAST(suppkey % 9 AS STRING), '"') AS school, min(race_id) AS remark
FROM race_times WHERE series <> 'RF' GROUP BY series, race_season, suppkey"""

# Entry forms of the athletes in the sheets, as they are filled in.
VIEWS["season_forms"] = """
SELECT CASE WHEN is_ghost_registration THEN 'GHOST' WHEN gender = 'b' THEN 'U16/EHS Qualifer - Boys' ELSE ' U16/EHS Qualifier - Girls ' END AS category,
  'Skier' AS first_name, substr(athlete_id, 2) AS last_name, lower(city_town) AS city, lower(state) AS state, lower(school) AS school, '' AS school_oth,
  club, CASE WHEN gender = 'b' THEN 'M' ELSE 'f' END AS gender, CAST(nensa_number AS STRING) AS nensa, CAST(usss_number AS STRING) AS usss,
  CAST(birth_year AS STRING) AS birth_year, CAST(grade AS STRING) AS grade, race_season
FROM dim_registrations"""

STAGED_REGISTRATION_NAMES = {
    "category": "Category Entered / Merchandise Ordered",
    "first_name": "First Name",
    "last_name": "Last Name",
    "city": "City",
    "state": "State",
    "school": "School",
    "school_oth": "SchoolOth",
    "club": "Club",
    "gender": "Gender",
    "nensa": "NENSA License",
    "usss": "USSS Member #",
    "birth_year": "Birth Year",
    "grade": "Grade",
}

# Race list as it is kept by hand: one race per season and series, its date as text (some unreadable).
VIEWS["race_list"] = """
SELECT concat(series, CAST(race_season AS STRING)) AS race_id,
  CASE WHEN series = 'AO' THEN 'soon' ELSE concat(CAST(min(race_date) AS STRING), ' 10:30:00') END AS date,
  concat('Race ', series) AS name, series, 'CL' AS technique, 'DI' AS discipline, 'mass' AS format, 'D1' AS division,
  concat('Venue ', series) AS venue, 'VT' AS state, race_season,
  concat(' prep_results_', series, CAST(race_season AS STRING), '_b ') AS boys_results_name,
  CASE WHEN series = 'NO' THEN '  ' ELSE concat('prep_results_', series, CAST(race_season AS STRING), '_g') END AS girls_results_name
FROM race_times GROUP BY series, race_season"""

# Sheets as files; no file exists for series RF, and NO has one that no race asks for.
VIEWS["sheet_rows"] = """
SELECT concat('prep_results_', series, CAST(race_season AS STRING), CASE WHEN suppkey % 2 = 0 THEN '_b' ELSE '_g' END) AS sheet_name, series,
  concat('Skier ', CAST(suppkey AS STRING)) AS name, CASE WHEN time_float IS NULL THEN 'DNF' ELSE concat(CAST(CAST(floor(time_float) AS BIGINT) AS STRING), ':',
    CAST(CAST(floor((time_float - floor(time_float)) * 60) AS BIGINT) AS STRING)) END AS time,
  CAST(suppkey + 5000 AS STRING) AS usss, concat('School, "', CAST(suppkey % 9 AS STRING), '"') AS school, race_id AS remark
FROM race_times WHERE series <> 'RF'"""

VIEWS["inventory"] = """
SELECT sheet_name, concat('id_', sheet_name) AS source_file_id, make_date(2026, 1, 1) AS modified_at FROM sheet_rows GROUP BY sheet_name"""

TABLES = ["lineitem", "customer", "supplier"]

# Views that stand for tables a user would have: written once per session, then scanned.
STORED = [
    "race_times",
    "dim_races",
    "dim_registrations",
    "publications",
    "contribution_windows",
    "point_series",
    "stand_in_penalties",
]
_stored: dict[tuple[str, str, str], DataFrame] = {}


def mentioned(text: str, names: Iterable[str]) -> list[str]:
    return [name for name in names if re.search(rf"\b{name}\b", text)]


def with_clause(body: str, extra: str = "") -> str:
    """The views that ``body`` and ``extra`` need, as common table expressions."""
    needed, queue = set(), mentioned(body + extra, VIEWS)
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue += mentioned(VIEWS[name], VIEWS)
    parts = [f"{name} AS ({text})" for name, text in VIEWS.items() if name in needed]
    return "WITH " + ",\n".join(parts + ([extra] if extra else [])) + "\n"


def check_sql(body: str, extra: str = "") -> str:
    """A complete DuckDB statement over the views."""
    return with_clause(body, extra) + body


class Fixtures:
    """The views as DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def _make(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name not in STORED:
            return self._view(name)
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _stored:
            _stored[key] = durable(self._view(name), name)
        return _stored[key]

    def _view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        used = mentioned(text, [*VIEWS, *TABLES])
        for table in used:
            text = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", text)
        return self.spark.sql(text, **{t: getattr(self, t) for t in used if f"{{{t}}}" in text})
