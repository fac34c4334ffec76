"""The derived rental extracts as SQL common table expressions."""

AS_OF = "date '2026-07-15'"


def tfn(n: str) -> str:
    return f"CASE WHEN ({n}) % 3 = 0 THEN 't' WHEN ({n}) % 3 = 1 THEN 'f' END"


def tenth(m: int) -> str:
    return f"(((k % {m}) // 10 + 3)::varchar || '.' || ((k % {m}) % 10)::varchar)"


def reviewed(expr: str) -> str:
    return f"CASE WHEN k % 8 <> 0 THEN {expr} END"


def places() -> str:
    return """
SELECT n_nationkey, n_name,
       CASE r_regionkey WHEN 1 THEN 'madrid' WHEN 2 THEN 'malaga' WHEN 3 THEN 'mallorca'
                        WHEN 4 THEN 'sevilla' ELSE lower(r_name) END AS city
FROM nation JOIN region ON n_regionkey = r_regionkey"""


def raw_listings(where: str = "true") -> str:
    known = "CASE WHEN k % 19 <> 0 THEN {}::varchar END"
    return f"""
SELECT k::varchar AS id,
       strftime(date '2026-06-20' + (k % 13 - CASE WHEN k % 5 = 0 THEN 91 ELSE 0 END
                - CASE WHEN copy = 'rescrape' THEN 7 ELSE 0 END)::int, '%Y-%m-%d') AS last_scraped,
       'Listing ' || k::varchar AS name,
       o_custkey::varchar AS host_id,
       c_name AS host_name,
       CASE WHEN o_custkey % 60 = 0 THEN 'unknown'
            ELSE strftime(date '2008-01-01' + (o_custkey * 17 % 6000)::int, '%Y-%m-%d') END AS host_since,
       'within an hour' AS host_response_time,
       CASE WHEN k % 13 = 0 THEN 'N/A' ELSE (k % 101)::varchar || '%' END AS host_response_rate,
       CASE WHEN k % 17 <> 0 THEN (k % 89)::varchar || '%' END AS host_acceptance_rate,
       {tfn("o_custkey")} AS host_is_superhost,
       {tfn("o_custkey + 1")} AS host_has_profile_pic,
       {tfn("o_custkey + 2")} AS host_identity_verified,
       CASE WHEN k % 509 = 0 THEN NULL WHEN k % 40 = 0 THEN 'no asignado'
            ELSE ' ' || n_name || '/' || (CASE WHEN k % 3 = 0 THEN 0 ELSE k % 8 END)::varchar
                 || CASE WHEN k % 7 = 0 THEN ' ' ELSE '' END END AS neighbourhood_cleansed,
       '36.' || lpad((k % 1000)::varchar, 3, '0') AS latitude,
       '-' || (k % 6)::varchar || '.' || lpad((k * 7 % 1000)::varchar, 3, '0') AS longitude,
       CASE WHEN k % 2 = 0 THEN 'Entire rental unit' ELSE 'Private room in home' END AS property_type,
       CASE WHEN k % 997 = 0 THEN NULL WHEN k % 499 = 0 THEN 'Tent'
            WHEN kind IN ('1', '2') THEN 'Entire home/apt' WHEN kind = '3' THEN 'Private room'
            WHEN kind = '4' THEN 'Hotel room' ELSE 'Shared room' END AS room_type,
       (k % 9)::varchar AS accommodates,
       (k % 5)::varchar || '.5' AS bathrooms,
       (k % 5)::varchar || '.5 baths' AS bathrooms_text,
       (k % 6)::varchar AS bedrooms,
       CASE WHEN k % 6 <> 0 THEN (k % 6)::varchar || '.0' END AS beds,
       '["Wifi", "Kitchen"]' AS amenities,
       CASE WHEN k % 11 = 0 THEN NULL WHEN k % 97 = 0 THEN 'N/A'
            ELSE '$' || format('{{:,.2f}}', o_totalprice) END AS price,
       CASE WHEN k % 29 = 0 THEN (k % 30)::varchar || '.7' ELSE (k % 30)::varchar END AS minimum_nights,
       (k % 10 + 365)::varchar AS maximum_nights,
       {tfn("k")} AS has_availability,
       (k % 31)::varchar AS availability_30,
       (k % 61)::varchar AS availability_60,
       (k % 91)::varchar AS availability_90,
       CASE WHEN k % 31 = 0 THEN '' ELSE (k * 37 % 366)::varchar END AS availability_365,
       (k % 500)::varchar AS number_of_reviews,
       CASE WHEN k % 6 <> 0 THEN (k % 5)::varchar END AS number_of_reviews_ltm,
       (k % 3)::varchar AS number_of_reviews_l30d,
       (k % 50)::varchar AS number_of_reviews_ly,
       (k * 53 % 256)::varchar AS estimated_occupancy_l365d,
       CASE WHEN k % 11 <> 0 THEN '$' || format('{{:,.2f}}', o_totalprice) END AS estimated_revenue_l365d,
       {reviewed("strftime(date '2015-01-01' + (k % 3000)::int, '%Y-%m-%d')")} AS first_review,
       {reviewed("strftime(date '2026-07-01' - (k % 900)::int, '%Y-%m-%d')")} AS last_review,
       CASE WHEN k % 10 <> 0 THEN {tenth(21)} END AS review_scores_rating,
       {reviewed(tenth(20))} AS review_scores_accuracy,
       {reviewed(tenth(19))} AS review_scores_cleanliness,
       {reviewed(tenth(18))} AS review_scores_checkin,
       {reviewed(tenth(17))} AS review_scores_communication,
       {reviewed(tenth(16))} AS review_scores_location,
       {reviewed(tenth(15))} AS review_scores_value,
       CASE WHEN k % 4 <> 0 THEN 'HUT-' || k::varchar END AS license,
       {tfn("k + 1")} AS instant_bookable,
       {known.format("n_all")} AS calculated_host_listings_count,
       {known.format("n_entire")} AS calculated_host_listings_count_entire_homes,
       {known.format("n_private")} AS calculated_host_listings_count_private_rooms,
       {known.format("n_shared")} AS calculated_host_listings_count_shared_rooms,
       {reviewed("(k % 7)::varchar || '.' || lpad((k % 100)::varchar, 2, '0')")} AS reviews_per_month,
       CASE WHEN copy <> 'overlap' THEN city WHEN city = 'mallorca' THEN 'menorca' ELSE 'mallorca' END AS city
FROM (
  SELECT o.*, o_orderkey AS k, substr(o_orderpriority, 1, 1) AS kind, c_name, n_name, city,
         n_all, n_entire, n_private, n_shared
  FROM (SELECT * FROM orders WHERE {where}) o
  JOIN customer ON o_custkey = c_custkey
  JOIN ({places()}) p ON c_nationkey = n_nationkey
  JOIN (SELECT o_custkey AS hk, count(*) AS n_all,
               count(CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 1 END) AS n_entire,
               count(CASE WHEN substr(o_orderpriority, 1, 1) = '3' THEN 1 END) AS n_private,
               count(CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN 1 END) AS n_shared
        FROM orders WHERE {where} GROUP BY o_custkey) h ON hk = o_custkey
) b
JOIN (VALUES ('base', 1), ('rescrape', 17), ('double', 101), ('overlap', 103)) c(copy, every)
  ON b.k % c.every = 0"""


def raw_reviews() -> str:
    return f"""
SELECT l_orderkey::varchar AS listing_id,
       (l_orderkey * 10 + l_linenumber)::varchar AS id,
       CASE WHEN (l_orderkey + l_linenumber) % 50 = 0 THEN ''
            ELSE strftime((l_shipdate::date + interval 18 year)::date, '%Y-%m-%d') END AS date,
       l_partkey::varchar AS reviewer_id,
       'Guest ' || l_partkey::varchar AS reviewer_name,
       'Muy bien, todo perfecto' AS comments,
       CASE WHEN l_orderkey % 103 <> 0 THEN city WHEN city = 'mallorca' THEN 'menorca' ELSE 'mallorca' END AS city
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN ({places()}) p ON c_nationkey = n_nationkey"""
