"""The SQL counterpart of every query, with constants and statements of its own.

A statement is a body over named common table expressions; ``_with`` prepends those it needs.
"""

from __future__ import annotations

import re

from oracle.columns import LISTING_COLUMNS, LISTING_NULL_TOKENS
from oracle.fixture import AS_OF, raw_listings, raw_reviews

DAY = "try_strptime({}, '%Y-%m-%d')::date"


def rnd(expr: str, digits: int = 4) -> str:
    """Half-up rounding of the number as it is written out, once."""
    return f"round(cast(cast({expr} AS varchar) AS decimal(38,18)), {digits})::double"


def total(col: str) -> str:
    """A sum that does not depend on the order of its terms."""
    return f"sum(cast({col} AS decimal(38,6)))::double"


def mean(col: str) -> str:
    return f"({total(col)} / count({col}))"


def int_(col: str) -> str:
    return f"try_cast({col} AS bigint)"


def dbl(col: str) -> str:
    return f"try_cast({col} AS double)"


def money(col: str) -> str:
    return f"try_cast(replace(replace({col}, '$', ''), ',', '') AS double)"


def pct(col: str) -> str:
    return f"try_cast(replace({col}, '%', '') AS double)"


def flag(col: str, literal: str = "t") -> str:
    return f"CASE WHEN {col} = '{literal}' THEN true ELSE false END"


def md5(*cols: str) -> str:
    parts = " || '-' || ".join(f"coalesce({c}::varchar, '_dbt_utils_surrogate_key_null_')" for c in cols)
    return f"md5({parts})"


def availability_profile(col: str) -> str:
    return (
        f"CASE WHEN {col} < 60 THEN 'Casi sin disponibilidad' WHEN {col} < 180 THEN 'Uso parcial' "
        "ELSE 'Alta disponibilidad' END"
    )


def host_profile(col: str) -> str:
    return (
        f"CASE WHEN {col} >= 5 THEN 'Operador profesional' WHEN {col} >= 2 THEN 'Multipropiedad' "
        "ELSE 'Host individual' END"
    )


def share(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END) / nullif(count(*), 0) * 100"


SCORE = (
    f"({share('is_entire_home')}) * 0.5 + ({share('is_high_availability')}) * 0.3 "
    f"+ ({share("host_profile <> 'Host individual'")}) * 0.2"
)

ROOM_TYPES = (
    "(VALUES (1, 'Entire home/apt'), (2, 'Private room'), (3, 'Hotel room'), (4, 'Shared room')) "
    "rt(room_type_id, room_type)"
)

CITY_LABEL = (
    "CASE city WHEN 'madrid' THEN 'Madrid' WHEN 'malaga' THEN 'Málaga' WHEN 'mallorca' THEN 'Mallorca' "
    "WHEN 'sevilla' THEN 'Sevilla' WHEN 'menorca' THEN 'Menorca' ELSE upper(substr(city, 1, 1)) || substr(city, 2) END"
)


def star(raw: str, p: str = "") -> dict[str, str]:
    """Silver, dimensions and fact over a raw table; names carry the prefix ``p``."""
    window = """
SELECT f.* FROM {p}fact f JOIN (SELECT city AS c, max(snapshot_date) AS latest FROM {p}fact GROUP BY 1) m
  ON c IS NOT DISTINCT FROM f.city WHERE snapshot_date >= latest - {days}
QUALIFY row_number() OVER (PARTITION BY f.city, listing_id ORDER BY snapshot_date DESC) = 1"""
    return {
        f"{p}details": f"""
SELECT {int_("id")} AS listing_id, name, property_type, room_type,
       {flag("room_type", "Entire home/apt")} AS is_entire_home, {int_("accommodates")} AS accommodates,
       {dbl("bedrooms")} AS bedrooms, {dbl("beds")} AS beds, {dbl("bathrooms")} AS bathrooms, bathrooms_text,
       amenities, {flag("instant_bookable")} AS instant_bookable, license, city FROM {raw}""",
        f"{p}host": f"""
SELECT {int_("host_id")} AS host_id, {int_("id")} AS listing_id, host_name, {DAY.format("host_since")} AS host_since,
       (year({AS_OF}) - year({DAY.format("host_since")}))::int AS host_seniority_years,
       {flag("host_is_superhost")} AS host_is_superhost, host_response_time,
       {pct("host_response_rate")} AS host_response_rate, {pct("host_acceptance_rate")} AS host_acceptance_rate,
       {flag("host_has_profile_pic")} AS host_has_profile_pic,
       {flag("host_identity_verified")} AS host_identity_verified,
       {int_("calculated_host_listings_count")} AS calculated_host_listings_count,
       {int_("calculated_host_listings_count_entire_homes")} AS calc_listings_entire_homes,
       {int_("calculated_host_listings_count_private_rooms")} AS calc_listings_private_rooms,
       {int_("calculated_host_listings_count_shared_rooms")} AS calc_listings_shared_rooms,
       {host_profile(int_("calculated_host_listings_count_entire_homes"))} AS host_profile, city FROM {raw}""",
        f"{p}location": f"""
SELECT {int_("id")} AS listing_id, trim(neighbourhood_cleansed) AS neighbourhood_cleansed,
       {dbl("latitude")} AS latitude, {dbl("longitude")} AS longitude, city FROM {raw}""",
        f"{p}scores": f"""
SELECT {int_("id")} AS listing_id, {int_("number_of_reviews")} AS number_of_reviews,
       {int_("number_of_reviews_ltm")} AS number_of_reviews_ltm,
       {int_("number_of_reviews_l30d")} AS number_of_reviews_l30d, {int_("number_of_reviews_ly")} AS number_of_reviews_ly,
       {dbl("reviews_per_month")} AS reviews_per_month, {DAY.format("first_review")} AS first_review,
       {DAY.format("last_review")} AS last_review,
       ({AS_OF} - {DAY.format("last_review")})::int AS days_since_last_review,
       {", ".join(f"{dbl(c)} AS {c}" for c in LISTING_COLUMNS if c.startswith("review_scores_"))}, city FROM {raw}""",
        f"{p}caps": f"""
SELECT city, quantile_cont({money("price")}, 0.95) AS p95 FROM {raw} WHERE {money("price")} IS NOT NULL GROUP BY city""",
        f"{p}avail": f"""
SELECT {int_("id")} AS listing_id, price AS price_raw, {money("price")} AS price_numeric,
       CASE WHEN {money("price")} IS NOT NULL AND p95 IS NOT NULL THEN least({money("price")}, p95) END
         AS price_winsorized,
       CASE WHEN {money("price")} IS NOT NULL AND p95 IS NOT NULL THEN least({money("price")}, p95) END
         / nullif({int_("accommodates")}, 0) AS price_per_person,
       {int_("minimum_nights")} AS minimum_nights, {int_("maximum_nights")} AS maximum_nights,
       {flag("has_availability")} AS has_availability, {int_("availability_30")} AS availability_30,
       {int_("availability_60")} AS availability_60, {int_("availability_90")} AS availability_90,
       {int_("availability_365")} AS availability_365,
       CASE WHEN {int_("availability_365")} > 180 THEN true ELSE false END AS is_high_availability,
       {availability_profile(int_("availability_365"))} AS availability_profile,
       {dbl("estimated_occupancy_l365d")} AS estimated_occupancy_l365d,
       {money("estimated_revenue_l365d")} AS estimated_revenue_l365d,
       CASE WHEN {money("price")} IS NOT NULL AND p95 IS NOT NULL THEN least({money("price")}, p95) END
         * nullif({dbl("estimated_occupancy_l365d")}, 0) AS estimated_revenue_adjusted,
       {DAY.format("last_scraped")} AS last_scraped, r.city
FROM {raw} r LEFT JOIN {p}caps c ON r.city = c.city""",
        f"{p}dim_neighbourhood": f"""
SELECT {md5("neighbourhood_cleansed", "city")} AS neighbourhood_id, neighbourhood_cleansed, city
FROM (SELECT DISTINCT neighbourhood_cleansed, city FROM {p}location WHERE neighbourhood_cleansed <> 'no asignado') d""",
        f"{p}dedup_host": f"""
SELECT * FROM {p}host WHERE host_id IS NOT NULL QUALIFY row_number() OVER (
  PARTITION BY host_id, city ORDER BY calculated_host_listings_count DESC NULLS LAST) = 1""",
        f"{p}dim_host": f"""
SELECT {md5("host_id", "city")} AS host_sk, host_id, city, host_name, host_since, host_seniority_years,
       host_is_superhost, calculated_host_listings_count, calc_listings_entire_homes, host_profile,
       CASE WHEN calculated_host_listings_count > 1 THEN true ELSE false END AS is_multihost FROM {p}dedup_host""",
        f"{p}dim_listing": f"""
SELECT d.listing_id, room_type_id, neighbourhood_id, d.name, d.property_type, d.room_type, d.is_entire_home,
       d.accommodates, d.neighbourhood_cleansed, d.latitude, d.longitude, d.city
FROM (SELECT {int_("id")} AS listing_id, name, property_type, room_type,
             {flag("room_type", "Entire home/apt")} AS is_entire_home, {int_("accommodates")} AS accommodates,
             trim(neighbourhood_cleansed) AS neighbourhood_cleansed, {dbl("latitude")} AS latitude,
             {dbl("longitude")} AS longitude, city FROM {raw}
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY last_scraped DESC, city) = 1) d
LEFT JOIN {p}dim_neighbourhood n ON d.neighbourhood_cleansed = n.neighbourhood_cleansed AND d.city = n.city
LEFT JOIN {ROOM_TYPES} ON d.room_type = rt.room_type""",
        f"{p}fact": f"""
SELECT a.listing_id, h.host_sk, n.neighbourhood_id, rt.room_type_id, price_winsorized, price_per_person,
       availability_profile, availability_365, is_high_availability, estimated_occupancy_l365d,
       estimated_revenue_l365d, estimated_revenue_adjusted, number_of_reviews_ltm, reviews_per_month,
       review_scores_rating, days_since_last_review,
       CASE WHEN price_winsorized IS NOT NULL AND availability_365 > 0
             AND (number_of_reviews_ltm > 0 OR last_review >= ({AS_OF} - interval 6 month)::date)
            THEN true ELSE false END AS is_active_listing,
       is_entire_home, h.host_profile, a.city, a.last_scraped AS snapshot_date
FROM (SELECT DISTINCT * FROM {p}avail QUALIFY row_number() OVER (PARTITION BY listing_id, last_scraped ORDER BY city) = 1) a
LEFT JOIN (SELECT DISTINCT * FROM {p}scores) s ON s.listing_id = a.listing_id AND s.city = a.city
LEFT JOIN (SELECT DISTINCT listing_id, city, room_type, is_entire_home FROM {p}details) d
  ON d.listing_id = a.listing_id AND d.city = a.city
LEFT JOIN (SELECT DISTINCT listing_id, city, neighbourhood_cleansed FROM {p}location) l
  ON l.listing_id = a.listing_id AND l.city = a.city
LEFT JOIN (SELECT DISTINCT listing_id, city, host_id FROM {p}host) b ON b.listing_id = a.listing_id AND b.city = a.city
LEFT JOIN {p}dim_host h ON h.host_id = b.host_id AND h.city = b.city
LEFT JOIN {p}dim_neighbourhood n ON n.neighbourhood_cleansed = l.neighbourhood_cleansed AND n.city = a.city
LEFT JOIN {ROOM_TYPES} ON rt.room_type = d.room_type""",
        f"{p}latest": window.format(p=p, days=30),
        f"{p}sliver": window.format(p=p, days=0),
    }


def mart_neighbourhood(latest: str) -> str:
    return f"""
SELECT neighbourhood_cleansed, f.city, count(*) AS total_listings,
       count(CASE WHEN is_active_listing THEN 1 END) AS total_active_listings,
       count(CASE WHEN f.is_entire_home THEN 1 END) AS total_entire_home,
       {rnd(share("f.is_entire_home"), 2)} AS pct_entire_home,
       count(CASE WHEN is_high_availability THEN 1 END) AS total_high_availability,
       {rnd(share("is_high_availability"), 2)} AS pct_high_availability,
       {rnd("median(price_winsorized)", 2)} AS median_price_winsorized,
       {rnd(mean("price_per_person"), 2)} AS avg_price_per_person,
       {rnd(mean("estimated_occupancy_l365d"), 1)} AS avg_occupancy_days,
       {rnd(mean("estimated_revenue_adjusted"), 2)} AS avg_estimated_revenue,
       count(CASE WHEN host_profile <> 'Host individual' THEN 1 END) AS total_multihost_listings,
       {rnd(share("host_profile <> 'Host individual'"), 2)} AS pct_multihost_listings,
       {rnd(share("host_profile = 'Operador profesional'"), 2)} AS pct_professional_operators,
       {rnd(mean("review_scores_rating"), 2)} AS avg_review_score,
       {rnd(SCORE.replace("is_entire_home", "f.is_entire_home"), 2)} AS pressure_score
FROM {latest} f LEFT JOIN dim_listing dl ON f.listing_id = dl.listing_id
WHERE neighbourhood_cleansed IS NOT NULL AND neighbourhood_cleansed <> 'no asignado'
GROUP BY neighbourhood_cleansed, f.city"""


def mart_host(latest: str) -> str:
    return f"""
SELECT host_id, host_name, h.host_profile, host_seniority_years, h.city,
       calculated_host_listings_count AS total_listings, calc_listings_entire_homes AS entire_home_listings,
       {rnd("calc_listings_entire_homes / nullif(calculated_host_listings_count, 0) * 100", 2)} AS pct_entire_home,
       {rnd(mean("price_per_person"), 2)} AS avg_price_per_person,
       {rnd(mean("estimated_occupancy_l365d"), 1)} AS avg_occupancy,
       {rnd(total("estimated_revenue_adjusted"), 2)} AS estimated_annual_revenue, host_is_superhost AS is_superhost
FROM dim_host h LEFT JOIN {latest} f ON h.host_sk = f.host_sk
GROUP BY host_id, host_name, h.host_profile, host_seniority_years, h.city, calculated_host_listings_count,
         calc_listings_entire_homes, host_is_superhost"""


def mart_city(latest: str) -> str:
    return f"""
SELECT f.city, count(*) AS total_listings, count(CASE WHEN is_active_listing THEN 1 END) AS total_active_listings,
       {rnd(share("is_entire_home"), 2)} AS pct_entire_home,
       {rnd("median(price_winsorized)", 2)} AS median_price_winsorized,
       {rnd(mean("price_per_person"), 2)} AS avg_price_per_person,
       {rnd(mean("estimated_occupancy_l365d"), 1)} AS avg_occupancy_days,
       {rnd(mean("estimated_revenue_adjusted"), 2)} AS avg_estimated_revenue,
       count(DISTINCT host_id) AS total_hosts,
       {rnd('''count(DISTINCT CASE WHEN h.host_profile = 'Operador profesional' THEN host_id END)
             / nullif(count(DISTINCT host_id), 0) * 100''', 2)} AS pct_professional_operators,
       {rnd(share("f.host_profile <> 'Host individual'"), 2)} AS pct_multihost_listings,
       {rnd(mean("review_scores_rating"), 2)} AS avg_review_score
FROM {latest} f LEFT JOIN dim_host h ON f.host_sk = h.host_sk GROUP BY f.city"""


def consistency(city_mart: str, neighbourhood_mart: str, host_mart: str) -> str:
    def reconcile(name: str, mart: str, fact: str) -> str:
        return f"""
SELECT '{name}' AS mart, city, 'listings: fact=' || coalesce(f.n, 0) || ' vs mart=' || coalesce(m.n, 0) || ' (diff '
       || coalesce(printf('%.1f', {rnd("abs(coalesce(m.n, 0) - f.n) / nullif(f.n, 0) * 100", 1)}), 'n/a')
       || '% > 5%)' AS detail
FROM ({mart}) m FULL JOIN ({fact}) f USING (city)
WHERE coalesce(abs(coalesce(m.n, 0) - f.n) / nullif(f.n, 0) * 100 > 5, true)"""

    by_city = f"SELECT city, total_listings AS n FROM {city_mart}"
    by_place = f"SELECT city, sum(total_listings)::bigint AS n FROM {neighbourhood_mart} GROUP BY city"
    fact = "SELECT city, count(*) AS n FROM latest GROUP BY city"
    placed = """SELECT f.city, count(*) AS n FROM latest f JOIN dim_listing dl USING (listing_id)
WHERE neighbourhood_cleansed <> 'no asignado' GROUP BY f.city"""
    return " UNION ALL ".join(
        [
            reconcile("mart_city_comparison", by_city, fact),
            reconcile("mart_neighbourhood_pressure", by_place, placed),
            coverage(host_mart, 40),
        ]
    )


def coverage(host_mart: str, floor: int) -> str:
    filled = "count(estimated_annual_revenue) / nullif(count(*), 0) * 100"
    return f"""
SELECT 'mart_host_profile' AS mart, city, 'cobertura revenue: ' || count(estimated_annual_revenue) || '/' || count(*)
       || ' hosts (' || printf('%.1f', {rnd(filled, 1)}) || '% < {floor}%)' AS detail
FROM {host_mart} GROUP BY city HAVING {filled} < {floor}"""


CTES: dict[str, str] = {
    "raw": raw_listings(),
    "raw_rev": raw_reviews(),
    **star("raw"),
    "reviews": f"""
SELECT {int_("id")} AS review_id, {int_("listing_id")} AS listing_id, {int_("reviewer_id")} AS reviewer_id,
       {DAY.format("date")} AS review_date, year({DAY.format("date")})::int AS review_year,
       month({DAY.format("date")})::int AS review_month,
       date_trunc('month', {DAY.format("date")})::date AS review_month_start, city FROM raw_rev""",
    "monthly": """
SELECT city, review_year, review_month, review_month_start, count(*) AS total_reviews,
       count(DISTINCT listing_id) AS distinct_listings
FROM reviews WHERE review_date IS NOT NULL GROUP BY ALL""",
    "nbh_mart": mart_neighbourhood("latest"),
    "host_mart": mart_host("latest"),
    "city_mart": mart_city("latest"),
    "nbh_mart_sliver": mart_neighbourhood("sliver"),
    "host_mart_sliver": mart_host("sliver"),
    "city_mart_sliver": mart_city("sliver"),
    "by_year": f"""
SELECT review_year, {CITY_LABEL} AS ciudad, sum(total_reviews)::bigint AS total_reviews
FROM monthly WHERE review_year >= 2015 GROUP BY ALL""",
    # Two loads of the fact: without one city, then the partitions that the first had not seen.
    "raw_one": "SELECT * FROM raw WHERE city <> 'mallorca'",
    **star("raw_one", "one_"),
    "raw_two": f"""
SELECT * FROM raw WHERE NOT EXISTS (
  SELECT 1 FROM one_fact f WHERE f.city = raw.city AND f.snapshot_date = {DAY.format("last_scraped")})""",
    **{
        name: text.replace("two_caps", "caps").replace("two_dim_host", "dim_host")
        for name, text in star("raw_two", "two_").items()
        if name not in ("two_caps", "two_dim_host", "two_dedup_host")
    },
    # Two states of the host dimension.
    "raw_a": raw_listings("o_orderdate < timestamp '2000-01-01'"),
    "raw_b": raw_listings("o_custkey % 50 <> 0"),
    **star("raw_a", "a_"),
    **star("raw_b", "b_"),
    # All hosts in three states: as they are, later, as they are again.
    "states": """
SELECT *, host_id % 50 = 0 AS vanished, CASE WHEN host_id % 7 = 0 THEN calculated_host_listings_count + 1
            ELSE calculated_host_listings_count END AS later_count,
       CASE WHEN host_id % 21 = 0 THEN 'Operador profesional' ELSE host_profile END AS later_profile FROM dim_host""",
    "moves": """
SELECT *, vanished OR later_count IS DISTINCT FROM calculated_host_listings_count
          OR later_profile IS DISTINCT FROM host_profile AS moved FROM states""",
    "logged": """
SELECT * EXCLUDE (vanished, later_count, later_profile, moved), date '2026-03-31' AS valid_from,
       CASE WHEN moved THEN date '2026-07-02' END AS valid_to, NOT moved AS is_current FROM moves
UNION ALL
SELECT * EXCLUDE (vanished, later_count, later_profile, moved)
         REPLACE (later_count AS calculated_host_listings_count, later_profile AS host_profile),
       date '2026-07-02', date '2026-08-15', false FROM moves WHERE moved AND NOT vanished
UNION ALL
SELECT * EXCLUDE (vanished, later_count, later_profile, moved), date '2026-08-15', NULL::date, true FROM moves WHERE moved""",
    "offered": r"""
SELECT id::bigint AS listing_id, city,
       CASE WHEN id::bigint % 13 = 0 THEN '["Wifi", "Kit' WHEN id::bigint % 17 = 0 THEN '{"Wifi": 1}'
            WHEN id::bigint % 19 = 0 THEN NULL WHEN id::bigint % 23 = 0 THEN '[]'
            ELSE '["Wifi"' || CASE WHEN id::bigint % 2 = 0 THEN ', "Kitchen"' ELSE '' END
              || CASE WHEN id::bigint % 3 = 0 THEN ', " Caf\u00e9, \"bar\" "' ELSE '' END
              || CASE WHEN id::bigint % 5 = 0 THEN ', null' ELSE '' END
              || CASE WHEN id::bigint % 7 = 0 THEN ', "Wifi"' ELSE '' END
              || CASE WHEN id::bigint % 11 = 0 THEN ', ""' ELSE '' END || ']' END AS amenities FROM raw""",
    "bridge": """
SELECT DISTINCT listing_id, city, trim(item) AS amenity
FROM (SELECT listing_id, city, unnest(from_json(amenities, '["VARCHAR"]')) AS item FROM offered
      WHERE json_valid(amenities) AND json_type(amenities) = 'ARRAY') o WHERE trim(item) <> ''""",
    "history": """
SELECT a.*, date '2026-03-31' AS valid_from,
       CASE WHEN b.host_sk IS NULL OR a.calculated_host_listings_count IS DISTINCT FROM b.calculated_host_listings_count
              OR a.host_profile IS DISTINCT FROM b.host_profile THEN date '2026-07-02' END AS valid_to
FROM a_dim_host a LEFT JOIN b_dim_host b ON a.host_sk = b.host_sk
UNION ALL
SELECT b.*, date '2026-07-02', NULL FROM b_dim_host b LEFT JOIN a_dim_host a ON a.host_sk = b.host_sk
WHERE a.host_sk IS NULL OR a.calculated_host_listings_count IS DISTINCT FROM b.calculated_host_listings_count
   OR a.host_profile IS DISTINCT FROM b.host_profile""",
    "versions": "SELECT *, valid_to IS NULL AS is_current FROM history",
}


def _needed(text: str, found: dict[str, None]) -> None:
    for name in re.findall(r"\b(?:FROM|JOIN)\s+\(?\s*(\w+)", text):
        if name in CTES and name not in found:
            _needed(CTES[name], found)
            found[name] = None


def _with(body: str) -> str:
    found: dict[str, None] = {}
    _needed(body, found)
    if not found:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in found) + "\n" + body


def _columns(exclude: dict[str, str], table: str) -> str:
    """``*`` with some columns replaced."""
    replaced = ", ".join(f"{expr} AS {name}" for name, expr in exclude.items())
    return f"SELECT * REPLACE ({replaced}) FROM {table}"


def _rounded(table: str, columns: list[str], digits: int = 4) -> str:
    return _columns({c: rnd(c, digits) for c in columns}, table)


FACT_DOUBLES = [
    "price_winsorized",
    "price_per_person",
    "estimated_occupancy_l365d",
    "estimated_revenue_l365d",
    "estimated_revenue_adjusted",
    "reviews_per_month",
    "review_scores_rating",
]
AVAILABILITY_DOUBLES = ["price_numeric", *FACT_DOUBLES[:5]]
SCORE_DOUBLES = ["reviews_per_month", *[c for c in LISTING_COLUMNS if c.startswith("review_scores_")]]


def _null_rules() -> str:
    rules = {
        "details": ("stg_details", ["listing_id", "room_type", "city"]),
        "host": ("stg_host", ["host_id", "listing_id", "host_profile"]),
        "location": ("stg_location", ["listing_id", "neighbourhood_cleansed"]),
        "avail": ("stg_availability", ["listing_id"]),
        "scores": ("stg_review_scores", ["listing_id"]),
        "reviews": ("stg_reviews", ["review_id", "listing_id"]),
        "dim_neighbourhood": ("dim_neighbourhood", ["neighbourhood_id", "neighbourhood_cleansed", "city"]),
        "dim_listing": ("dim_listing", ["listing_id", "is_entire_home"]),
        "dim_host": ("dim_host", ["host_sk", "host_id", "host_profile"]),
        "fact": ("fact_listings", ["is_active_listing", "snapshot_date"]),
        "monthly": ("fact_reviews_monthly", ["total_reviews", "distinct_listings"]),
        "nbh_mart": ("mart_neighbourhood_pressure", ["neighbourhood_cleansed", "pressure_score"]),
        "host_mart": ("mart_host_profile", ["host_id", "host_profile"]),
        "city_mart": ("mart_city_comparison", ["city"]),
    }
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
        f"count(CASE WHEN {c} IS NULL THEN 1 END) AS violations FROM {cte}"
        for cte, (table, columns) in rules.items()
        for c in columns
    )


def _repeats(cte: str, table: str, columns: list[str]) -> str:
    value = " || '|' || ".join(f"{c}::varchar" for c in columns)
    return (
        f"SELECT '{table}' AS table_name, '{','.join(columns)}' AS column_name, {value} AS value, "
        f"count(*) AS n_rows FROM {cte} GROUP BY {', '.join(columns)} HAVING count(*) > 1"
    )


def _outside(cte: str, table: str, column: str, domain: list[str], severity: str = "error") -> str:
    values = ", ".join(f"'{v}'" for v in domain)
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, {column} AS value, count(*) AS n_rows, "
        f"'{severity}' AS severity FROM {cte} WHERE {column} NOT IN ({values}) GROUP BY {column}"
    )


def _orphans(child: str, column: str, parents: str, shown: str) -> str:
    return (
        f"SELECT 'fact_listings' AS table_name, '{shown}' AS column_name, {column} AS orphan, count(*) AS n_rows "
        f"FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN ({parents}) GROUP BY {column}"
    )


HOST_DOMAIN = ["Host individual", "Multipropiedad", "Operador profesional"]
AVAILABILITY_DOMAIN = ["Casi sin disponibilidad", "Uso parcial", "Alta disponibilidad"]
ROOM_DOMAIN = ["Entire home/apt", "Private room", "Hotel room", "Shared room"]
CITY_DOMAIN = ["sevilla", "malaga", "barcelona", "girona", "euskadi", "valencia", "madrid", "mallorca", "menorca"]


def _expressions() -> dict[str, str]:
    entire = int_("calculated_host_listings_count_entire_homes")
    return {
        "expr_try_cast": f"""
SELECT {int_("id")} AS listing_id, {int_("minimum_nights")} AS minimum_nights,
       {int_("availability_365")} AS availability_365, {int_("host_since")} AS not_a_number,
       {dbl("bathrooms")} AS bathrooms, {dbl("latitude")} AS latitude, {dbl("price")} AS not_a_double FROM raw""",
        "expr_currency": f"SELECT id, {money('price')} AS price_numeric FROM raw",
        "expr_percent": f"""
SELECT id, {pct("host_response_rate")} AS response_rate, {pct("host_acceptance_rate")} AS acceptance_rate FROM raw""",
        "expr_bool_flag": f"""
SELECT id, {flag("has_availability")} AS has_availability, {flag("host_is_superhost")} AS is_superhost,
       {flag("room_type", "Entire home/apt")} AS is_entire_home FROM raw""",
        "expr_threshold_flag": f"""
SELECT id, CASE WHEN {int_("availability_365")} > 180 THEN true ELSE false END AS is_high_availability,
       CASE WHEN {int_("calculated_host_listings_count")} > 1 THEN true ELSE false END AS is_multihost FROM raw""",
        "expr_bucket_availability": f"""
SELECT id, {availability_profile(int_("availability_365"))} AS availability_profile FROM raw""",
        "expr_bucket_host": f"SELECT id, {host_profile(entire)} AS host_profile FROM raw",
        "expr_is_active": f"""
SELECT id, CASE WHEN {money("price")} IS NOT NULL AND {int_("availability_365")} > 0
             AND ({int_("number_of_reviews_ltm")} > 0
                  OR {DAY.format("last_review")} >= ({AS_OF} - interval 6 month)::date)
            THEN true ELSE false END AS is_active_listing FROM raw""",
        "expr_trim": "SELECT id, trim(neighbourhood_cleansed) AS neighbourhood_cleansed FROM raw",
        "expr_try_date": f"""
SELECT id, {DAY.format("host_since")} AS host_since, {DAY.format("last_scraped")} AS last_scraped,
       {DAY.format("last_review")} AS last_review FROM raw""",
        "expr_years_since": f"""
SELECT id, datediff('year', {DAY.format("host_since")}, {AS_OF})::int AS seniority_years FROM raw""",
        "expr_days_since": f"""
SELECT id, datediff('day', {DAY.format("last_review")}, {AS_OF})::int AS days_since FROM raw""",
        "expr_date_parts": f"""
SELECT id, year({DAY.format("date")})::int AS review_year, month({DAY.format("date")})::int AS review_month,
       date_trunc('month', {DAY.format("date")})::date AS review_month_start FROM raw_rev""",
        "expr_safe_divide": f"""
SELECT id, {rnd(f"{money('price')} / nullif({int_('accommodates')}, 0)")} AS price_per_person FROM raw""",
    }


def _sources() -> dict[str, str]:
    given = set(re.findall(r"AS (\w+)", raw_listings()))
    aligned = ", ".join(
        f"{c}" if c in given and c != "license" else f"NULL::varchar AS {c}" for c in LISTING_COLUMNS
    )
    tokens = ", ".join(f"'{t}'" for t in LISTING_NULL_TOKENS)
    cleaned = ", ".join(
        f"CASE WHEN {c} NOT IN ({tokens}) THEN {c} END AS {c}"
        for c in ("id", "price", "availability_365", "host_response_rate", "host_since")
    )

    def absent(col: str) -> str:
        return f"CASE WHEN {col} NOT IN ({tokens}) THEN {col} END"

    return {
        "src_schema_align": f"SELECT {aligned} FROM raw",
        "src_null_tokens": f"SELECT {cleaned} FROM raw",
        "src_tag_group": "SELECT id, price, 'madrid' AS city FROM raw",
        "src_group_reload": """
SELECT id, price, city FROM raw WHERE city NOT IN ('madrid', 'mallorca') OR price IS NOT NULL""",
        "val_group_counts": """
SELECT city, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, city) AS place FROM raw GROUP BY city""",
        "val_null_by_group": """
SELECT city, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, city) AS place
FROM raw WHERE room_type IS NULL GROUP BY city""",
        "src_csv_listings": f"""
SELECT id, name, amenities, {absent("price")} AS price, {absent("host_since")} AS host_since, NULL::varchar AS license, city
FROM raw""",
        "src_csv_reviews": """
SELECT listing_id, id, nullif(date, '') AS date, reviewer_id, reviewer_name, comments, city FROM raw_rev
WHERE city = 'madrid'""",
        "src_csv_reviews_all": """
SELECT listing_id, id, nullif(date, '') AS date, reviewer_id, reviewer_name, comments, city FROM raw_rev""",
        "src_bad_rows": f"""
SELECT city, CASE WHEN fits THEN id END AS id, CASE WHEN fits THEN name END AS name,
       CASE WHEN fits THEN {absent("availability_365")} END AS availability_365,
       CASE WHEN id::bigint % 41 = 0 THEN id
            WHEN NOT fits THEN id || ',"' || name || '",' || coalesce(availability_365, '') || ',surplus' END AS row
FROM (SELECT *, id::bigint % 41 <> 0 AND id::bigint % 37 <> 0 AS fits FROM raw) r""",
        "src_table_versions": "SELECT * FROM monthly WHERE review_year >= 2015",
        "src_export_fold": "SELECT * FROM dim_neighbourhood",
        "src_export_summary": """
SELECT 2 AS tables, (SELECT count(*) FROM dim_neighbourhood) + (SELECT count(*) FROM monthly) AS n_rows, true AS has_size""",
        "expr_format": """
SELECT o_orderkey AS id, format('{:,}', (o_orderkey * 1000 + 7)::bigint) AS shown_count,
       printf('%.1f', (o_orderkey % 4001) / 40) || '%' AS shown_pct,
       '$' || format('{:,}', round_even(o_orderkey * 7 / 2, 0)::bigint) AS shown_money FROM orders""",
    }


def _tables() -> dict[str, str]:
    newest = f"SELECT {int_('id')} AS listing_id, {DAY.format('last_scraped')} AS snapshot_date, city FROM raw"
    return {
        "stg_details": "SELECT * FROM details",
        "stg_host": "SELECT * FROM host",
        "stg_location": "SELECT * FROM location",
        "stg_availability": _rounded("avail", AVAILABILITY_DOUBLES),
        "stg_reviews_scores": _rounded("scores", SCORE_DOUBLES),
        "stg_reviews": "SELECT * FROM reviews",
        "winsorize_p95": f"""
SELECT l_orderkey, l_linenumber, l_returnflag, {rnd("l_extendedprice")} AS l_extendedprice,
       {rnd("least(l_extendedprice, p95)")} AS price_winsorized
FROM lineitem JOIN (SELECT l_returnflag AS g, quantile_cont(l_extendedprice, 0.95) AS p95 FROM lineitem GROUP BY 1) q
  ON g = l_returnflag""",
        "agg_percentile": f"""
SELECT l_returnflag, l_linestatus, {rnd("quantile_cont(l_extendedprice, 0.95)")} AS p95_price
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
        "agg_composite_score": f"""
SELECT neighbourhood_cleansed, city, {rnd(SCORE, 2)} AS score
FROM (SELECT city, trim(neighbourhood_cleansed) AS neighbourhood_cleansed,
             {flag("room_type", "Entire home/apt")} AS is_entire_home,
             coalesce({int_("availability_365")} > 180, false) AS is_high_availability,
             {host_profile(int_("calculated_host_listings_count_entire_homes"))} AS host_profile FROM raw) t
GROUP BY neighbourhood_cleansed, city""",
        "dim_surrogate_key": f"""
SELECT listing_id, {md5("host_id", "city")} AS host_sk, {md5("host_since", "city")} AS key_with_null FROM host""",
        "dim_neighbourhood": "SELECT * FROM dim_neighbourhood",
        "dim_listing": _rounded("dim_listing", ["latitude", "longitude"]),
        "dim_host": "SELECT * FROM dim_host",
        "seed_lookup_join": f"""
SELECT listing_id, d.room_type, room_type_id FROM details d LEFT JOIN {ROOM_TYPES} ON d.room_type = rt.room_type""",
        "join_left_single": """
SELECT f.listing_id, f.city, f.snapshot_date, dl.neighbourhood_cleansed
FROM latest f LEFT JOIN dim_listing dl ON f.listing_id = dl.listing_id""",
        "join_left_composite": """
SELECT l.listing_id, l.city, n.neighbourhood_id FROM location l
LEFT JOIN dim_neighbourhood n ON l.neighbourhood_cleansed = n.neighbourhood_cleansed AND l.city = n.city""",
        "dedup_host": "SELECT host_id, city, host_name, calculated_host_listings_count, host_profile FROM dedup_host",
        "dedup_listing": f"""
SELECT * FROM ({newest}) t QUALIFY row_number() OVER (
  PARTITION BY listing_id ORDER BY snapshot_date DESC, city) = 1""",
        "fact_star": _rounded("fact", FACT_DOUBLES),
        "fact_reviews_monthly": "SELECT * FROM monthly",
        "latest_window": f"""
SELECT * FROM ({newest}) t
QUALIFY snapshot_date >= max(snapshot_date) OVER (PARTITION BY city) - 30
    AND row_number() OVER (PARTITION BY city, listing_id ORDER BY snapshot_date DESC) = 1""",
        "incr_first_load": _rounded("one_fact", FACT_DOUBLES),
        "incr_new_partitions": _rounded(
            """(SELECT * FROM two_fact UNION ALL SELECT o.* FROM one_fact o WHERE NOT EXISTS (
  SELECT 1 FROM two_fact t WHERE t.listing_id = o.listing_id AND t.snapshot_date = o.snapshot_date)) u""",
            FACT_DOUBLES,
        ),
        "incr_old_version": _rounded("one_fact", FACT_DOUBLES),
        "scd2_log_history": "SELECT * FROM logged",
        "scd2_log_open": "SELECT * FROM logged WHERE is_current",
        "scd2_log_as_of": """
SELECT * FROM logged WHERE valid_from <= date '2026-07-20' AND (valid_to IS NULL OR valid_to > date '2026-07-20')""",
        "scd2_log_changed": """
SELECT a.host_sk, a.valid_to AS changed_on, a.calculated_host_listings_count AS old_calculated_host_listings_count,
       a.host_profile AS old_host_profile, b.calculated_host_listings_count AS new_calculated_host_listings_count,
       b.host_profile AS new_host_profile
FROM logged a JOIN logged b ON a.host_sk = b.host_sk AND a.valid_to = b.valid_from""",
        "join_copartitioned": f"""
SELECT f.listing_id, f.city, f.snapshot_date, dl.neighbourhood_cleansed, {rnd("f.price_winsorized")} AS price_winsorized
FROM fact f LEFT JOIN dim_listing dl ON f.listing_id = dl.listing_id""",
        "join_label_table": """
SELECT r.id, r.host_id, c.c_name AS host_label FROM raw r LEFT JOIN customer c ON r.host_id = c.c_custkey::varchar""",
        "stg_amenities": "SELECT * FROM bridge",
        "mart_amenities": """
SELECT b.city, b.amenity, count(*) AS n_listings, round(count(*) * 100 / t.listings, 2) AS pct_listings
FROM bridge b JOIN (SELECT city, count(DISTINCT id) AS listings FROM raw GROUP BY city) t ON t.city = b.city
GROUP BY b.city, b.amenity, t.listings""",
        "agg_distinct_sketch": """
SELECT city, review_year, count(DISTINCT reviewer_id) AS reviewers, true AS within_bound FROM reviews GROUP BY ALL""",
        "agg_quantile_sketch": """
SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, true AS within_bound FROM lineitem GROUP BY ALL""",
        "scd2_first_load": """
SELECT *, date '2026-03-31' AS valid_from, NULL::date AS valid_to, true AS is_current FROM a_dim_host""",
        "scd2_apply": "SELECT * FROM versions",
        "scd2_current": "SELECT * FROM versions WHERE valid_to IS NULL",
        "scd2_as_of": """
SELECT * FROM versions WHERE valid_from <= date '2026-05-01' AND (valid_to IS NULL OR valid_to > date '2026-05-01')""",
        "scd2_changed": """
SELECT a.host_sk, a.valid_to AS changed_on, a.calculated_host_listings_count AS old_calculated_host_listings_count,
       a.host_profile AS old_host_profile, b.calculated_host_listings_count AS new_calculated_host_listings_count,
       b.host_profile AS new_host_profile
FROM versions a JOIN versions b ON a.host_sk = b.host_sk AND a.valid_to = b.valid_from""",
        "mart_neighbourhood": "SELECT * FROM nbh_mart",
        "mart_host": "SELECT * FROM host_mart",
        "mart_city": "SELECT * FROM city_mart",
        "export_listings_dashboard": _rounded(
            """(SELECT f.listing_id, f.city, f.is_entire_home, is_high_availability, is_active_listing,
  price_winsorized, price_per_person, estimated_occupancy_l365d, estimated_revenue_adjusted, availability_365,
  availability_profile, host_profile, number_of_reviews_ltm, review_scores_rating, snapshot_date,
  n.neighbourhood_cleansed, latitude, longitude
FROM fact f LEFT JOIN dim_neighbourhood n ON f.neighbourhood_id = n.neighbourhood_id
LEFT JOIN dim_listing l ON f.listing_id = l.listing_id WHERE is_active_listing) e""",
            [c for c in FACT_DOUBLES if c not in ("estimated_revenue_l365d", "reviews_per_month")]
            + ["latitude", "longitude"],
        ),
    }


def _quality() -> dict[str, str]:
    return {
        "dq_not_null": _null_rules(),
        "dq_unique": " UNION ALL ".join(
            [
                _repeats("dim_neighbourhood", "dim_neighbourhood", ["neighbourhood_id"]),
                _repeats("dim_host", "dim_host", ["host_sk"]),
                _repeats("city_mart", "mart_city_comparison", ["city"]),
                _repeats("dim_host", "dim_host", ["host_id"]),
            ]
        ),
        "dq_unique_combo": " UNION ALL ".join(
            [
                _repeats("details", "stg_details", ["listing_id"]),
                _repeats("host", "stg_host", ["listing_id"]),
                _repeats("location", "stg_location", ["listing_id"]),
                _repeats("avail", "stg_availability", ["listing_id"]),
                _repeats("scores", "stg_review_scores", ["listing_id"]),
                _repeats("fact", "fact_listings", ["listing_id", "snapshot_date"]),
            ]
        ),
        "dq_accepted_values": " UNION ALL ".join(
            [
                _outside("details", "stg_details", "room_type", ROOM_DOMAIN, "warn"),
                _outside("details", "stg_details", "city", CITY_DOMAIN),
                _outside("host", "stg_host", "host_profile", HOST_DOMAIN),
                _outside("avail", "stg_availability", "availability_profile", AVAILABILITY_DOMAIN),
                _outside("dim_host", "dim_host", "host_profile", HOST_DOMAIN),
            ]
        ),
        "dq_relationships": " UNION ALL ".join(
            [
                _orphans(
                    "fact", "neighbourhood_id", "SELECT neighbourhood_id FROM dim_neighbourhood", "neighbourhood_id"
                ),
                _orphans("fact", "host_sk", "SELECT host_sk FROM dim_host", "host_sk"),
                _orphans(
                    "fact",
                    "neighbourhood_id",
                    "SELECT neighbourhood_id FROM dim_neighbourhood WHERE city = 'madrid'",
                    "neighbourhood_id in madrid",
                ),
            ]
        ),
        "dq_marts_consistency": consistency("city_mart", "nbh_mart", "host_mart"),
        "dq_marts_regression": consistency("city_mart_sliver", "nbh_mart_sliver", "host_mart_sliver"),
        "dq_revenue_coverage": coverage("host_mart", 90),
    }


def _dashboard() -> dict[str, str]:
    label = f"{CITY_LABEL} AS ciudad"
    pro = "host_profile = 'Operador profesional'"
    return {
        "dash_city_label": f"SELECT city, count(*) AS n, {label} FROM raw GROUP BY city",
        "dash_kpis_capture": f"""
SELECT sum(total_listings)::bigint AS total_listings, {rnd(mean("pct_entire_home"), 2)} AS pct_entire_home,
       {rnd(mean("avg_occupancy_days"), 2)} AS avg_occupancy_days,
       (SELECT count(DISTINCT neighbourhood_cleansed) FROM nbh_mart) AS total_neighbourhoods FROM city_mart""",
        "dash_neighbourhood_scatter": f"""
SELECT neighbourhood_cleansed, {label}, total_listings, pct_entire_home, total_entire_home, pressure_score
FROM nbh_mart WHERE total_listings >= 50""",
        "dash_reviews_by_year": "SELECT * FROM by_year",
        "dash_reviews_one_city": "SELECT * FROM by_year WHERE ciudad = 'Madrid'",
        "dash_reviews_national": """
SELECT review_year, sum(total_reviews)::bigint AS total_reviews FROM by_year GROUP BY review_year""",
        "dash_reviews_top5": """
SELECT * FROM by_year WHERE ciudad IN (
  SELECT ciudad FROM by_year GROUP BY ciudad ORDER BY sum(total_reviews) DESC, ciudad LIMIT 5)""",
        "dash_reviews_stacked": """
SELECT *, row_number() OVER (ORDER BY city_total DESC, ciudad, review_year) AS place
FROM (SELECT *, sum(total_reviews) OVER (PARTITION BY ciudad)::bigint AS city_total FROM by_year) y""",
        "dash_host_kpis": f"""
SELECT count(DISTINCT host_id) AS total_hosts,
       {rnd(f"count(DISTINCT CASE WHEN {pro} THEN host_id END) / greatest(count(DISTINCT host_id), 1) * 100", 2)}
         AS pct_professional_hosts,
       {rnd('''count(DISTINCT CASE WHEN host_profile <> 'Host individual' THEN host_id END)
             / greatest(count(DISTINCT host_id), 1) * 100''', 2)} AS pct_multi_hosts,
       {rnd(f'''coalesce(sum(CASE WHEN {pro} THEN total_listings END), 0)
             / greatest(sum(total_listings), 1) * 100''', 2)} AS pct_professional_listings FROM host_mart""",
        "dash_hosts_by_profile": """
SELECT host_profile, count(DISTINCT host_id) AS num_hosts FROM host_mart GROUP BY host_profile""",
        "dash_listings_by_profile": f"""
SELECT {label}, host_profile, sum(total_listings)::bigint AS total_listings FROM host_mart GROUP BY city, host_profile""",
        "dash_profile_pivot": f"""
SELECT {label}, coalesce(sum(CASE WHEN host_profile = 'Host individual' THEN total_listings END), 0)::bigint AS single_host,
       coalesce(sum(CASE WHEN host_profile = 'Multipropiedad' THEN total_listings END), 0)::bigint AS multi_host,
       coalesce(sum(CASE WHEN {pro} THEN total_listings END), 0)::bigint AS professional_host
FROM host_mart GROUP BY city""",
        "dash_kpis_money": f"""
SELECT {rnd(mean("median_price_winsorized"), 2)} AS median_price, {rnd(mean("avg_estimated_revenue"), 2)} AS avg_revenue,
       (SELECT {rnd(mean("estimated_annual_revenue"), 2)} FROM host_mart WHERE {pro}) AS avg_professional_revenue,
       {rnd(mean("pct_multihost_listings"), 2)} AS pct_multihost_listings FROM city_mart""",
        "dash_top_neighbourhoods": f"""
SELECT neighbourhood_cleansed, {label}, avg_estimated_revenue, median_price_winsorized, total_listings FROM nbh_mart
WHERE total_listings >= 20
ORDER BY avg_estimated_revenue DESC NULLS LAST, neighbourhood_cleansed, ciudad LIMIT 15""",
        "dash_city_table": f"""
SELECT {label}, total_listings, pct_entire_home, median_price_winsorized, avg_estimated_revenue,
       pct_professional_operators, row_number() OVER (ORDER BY total_listings DESC, {CITY_LABEL}) AS place
FROM city_mart""",
        "dash_top_hosts": f"""
SELECT host_name, {label}, total_listings, entire_home_listings, estimated_annual_revenue,
       row_number() OVER (ORDER BY estimated_annual_revenue DESC NULLS LAST, host_id, {CITY_LABEL}) AS place FROM host_mart
WHERE {pro} ORDER BY estimated_annual_revenue DESC NULLS LAST, host_id, ciudad LIMIT 10""",
    }


def all_sql() -> dict[str, str]:
    bodies = {**_expressions(), **_sources(), **_tables(), **_quality(), **_dashboard()}
    return {name: _with(body) for name, body in bodies.items()}
