"""The registered queries as SQL over the given tables.

Written from the definition of each result, not from the Spark plans: clean
ratings, say, start at ``events`` and never see a JSON message.
"""

from ratemill.functions.hashing import hash_bound

_EVENTS = """
rated AS (
  SELECT event_id, value, user_id::INTEGER AS user_id,
         json_extract_string(props, '$.k')::INTEGER AS movie_id,
         least(5.0, 1 + floor(value / 25))::DOUBLE AS rating,
         floor(epoch(ts))::BIGINT AS timestamp,
         least(2, (day(ts) - 1) // 10)::INTEGER AS wave
  FROM events
)"""

_RAW = f"""{_EVENTS},
raw AS (
  SELECT user_id, movie_id, rating, timestamp, wave FROM rated
  UNION ALL
  SELECT user_id, movie_id, rating, timestamp, wave FROM rated WHERE event_id % 10 = 3
  UNION ALL
  SELECT user_id, movie_id, 6 - rating, timestamp, wave FROM rated WHERE event_id % 50 = 7
  UNION ALL
  SELECT user_id, movie_id, NULL, timestamp, wave FROM rated WHERE event_id % 40 = 11
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, wave FROM rated WHERE event_id % 100 = 13
)"""

_CLEAN = """
silver AS (
  SELECT user_id, movie_id,
         max(CASE WHEN event_id % 50 = 7 THEN greatest(rating, 6 - rating)
                  ELSE rating END) AS rating,
         timestamp
  FROM rated GROUP BY user_id, movie_id, timestamp
)"""

_SILVER = f"{_EVENTS}, {_CLEAN}"

_SILVER_LARGE = """
silver AS (
  SELECT o_custkey::INTEGER AS user_id, l_partkey::INTEGER AS movie_id,
         max(1 + floor((l_quantity - 1) / 10))::DOUBLE AS rating,
         floor(epoch(l_shipdate))::BIGINT AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey, epoch(l_shipdate)
)"""

_ITEMS = """
items AS (
  SELECT p_partkey::INTEGER AS movie_id, p_name AS title, p_type AS genre,
         (1970 + p_size)::INTEGER AS release_year
  FROM part
)"""

_PROFILES = """
profiles AS (
  SELECT c_custkey::INTEGER AS user_id, c_name AS username,
         (18 + c_custkey % 43)::INTEGER AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         n_name AS location, c_mktsegment AS subscription_tier
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

_DAY = "(DATE '1970-01-01' + (timestamp // 86400)::INTEGER)"

_FACT = f"""
fact AS (
  SELECT user_id, movie_id, strftime({_DAY}, '%Y%m%d')::INTEGER AS date_id,
         {_DAY} AS day, rating
  FROM silver
)"""

_TRAINED = f"md5(concat_ws('|', user_id, movie_id, timestamp))[1:8] < '{hash_bound(0.8)}'"

_DATES = """
SELECT DISTINCT date_id, year(day)::INTEGER AS year, month(day)::INTEGER AS month,
       day(day)::INTEGER AS day
FROM fact"""


def _average(digits: int) -> str:
    return f"round(avg(rating)::DECIMAL(38,15), {digits})::DOUBLE AS average_rating"


_COUNT = "count(rating) AS total_ratings"

_TOP_ITEMS = f"""
SELECT title, {_average(2)}, {_COUNT}
FROM fact JOIN items USING (movie_id) GROUP BY title
ORDER BY average_rating DESC, total_ratings DESC, title LIMIT 10"""

_TREND = f"""
SELECT year(day)::INTEGER AS year, month(day)::INTEGER AS month, {_COUNT}, {_average(1)}
FROM fact GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC"""

_LOCATION_GENRE = f"""
SELECT location, genre, {_average(2)}, {_COUNT}
FROM fact JOIN profiles USING (user_id) JOIN items USING (movie_id)
GROUP BY location, genre
ORDER BY total_ratings DESC, location, genre LIMIT 10"""


def _reports(name: str, silver: str) -> dict[str, str]:
    return {
        f"top_items{name}": f"WITH {silver}, {_FACT}, {_ITEMS} {_TOP_ITEMS}",
        f"trend_by_month{name}": f"WITH {silver}, {_FACT} {_TREND}",
        f"location_genre{name}":
            f"WITH {silver}, {_FACT}, {_ITEMS}, {_PROFILES} {_LOCATION_GENRE}",
    }


def _check(table: str, key: str, keys: str) -> str:
    return f"""
SELECT 'duplicate_key' AS check_name, '{table}' AS table_name, count(*) AS bad_keys,
       coalesce(sum(n), 0)::BIGINT AS bad_rows
FROM (SELECT {key}, count(*) AS n FROM {keys} GROUP BY {key} HAVING count(*) > 1)
UNION ALL
SELECT 'orphan_fact', '{table}',
       count(DISTINCT {key}) + max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END)::BIGINT,
       count(*)
FROM fact
WHERE NOT EXISTS (SELECT 1 FROM {keys} AS k WHERE k.{key} = fact.{key})
HAVING count(*) > 0
UNION ALL
SELECT 'orphan_fact', '{table}', 0, 0
WHERE NOT EXISTS (
  SELECT 1 FROM fact WHERE NOT EXISTS (SELECT 1 FROM {keys} AS k WHERE k.{key} = fact.{key})
)"""


_STAR_CHECK = " UNION ALL ".join(
    [
        _check("dim_movie", "movie_id", "items"),
        _check("dim_user", "user_id", "profiles"),
        _check("dim_date", "date_id", "dates"),
    ]
)

_EVENT_JSON = (
    "'{\"user_id\":' || user_id || ',\"movie_id\":' || movie_id || "
    "',\"rating\":' || rating || ',\"timestamp\":' || timestamp || '}'"
)

_SUBMITTED = f"""{_EVENTS},
submitted AS (
  SELECT CASE event_id % 20 WHEN 2 THEN 'abc' WHEN 5 THEN ' 10 '
              ELSE user_id::VARCHAR END AS user_id,
         CASE event_id % 20 WHEN 3 THEN '10.9' ELSE movie_id::VARCHAR END AS movie_id,
         CASE event_id % 20 WHEN 1 THEN NULL WHEN 4 THEN 'nan'
              ELSE rating::VARCHAR END AS rating,
         timestamp, event_id
  FROM rated
)"""

_VALIDATED = f"""WITH {_SUBMITTED}
SELECT CASE WHEN event_id % 20 = 2 THEN NULL ELSE trim(user_id)::INTEGER END AS user_id,
       CASE WHEN event_id % 20 = 3 THEN NULL ELSE movie_id::INTEGER END AS movie_id,
       CASE WHEN event_id % 20 = 4 THEN NULL ELSE rating::DOUBLE END AS rating,
       timestamp,
       CASE event_id % 20 WHEN 1 THEN 'missing_rating' WHEN 2 THEN 'invalid_user_id'
            WHEN 3 THEN 'invalid_movie_id' WHEN 4 THEN 'invalid_rating' END AS reason
FROM submitted"""

_RAW_COLUMNS = "user_id, movie_id, rating, timestamp"

ORACLES: dict[str, str] = {
    "parse_events": f"WITH {_RAW} SELECT {_RAW_COLUMNS} FROM raw",
    "encode_events": f"WITH {_EVENTS} SELECT {_EVENT_JSON} AS value FROM rated",
    "bronze_stream": f"WITH {_RAW} SELECT {_RAW_COLUMNS} FROM raw",
    "snapshot_v0": f"WITH {_RAW} SELECT {_RAW_COLUMNS} FROM raw WHERE wave = 0",
    "bronze_compacted": f"WITH {_RAW} SELECT {_RAW_COLUMNS} FROM raw",
    "snapshot_v0_compacted": f"WITH {_RAW} SELECT {_RAW_COLUMNS} FROM raw WHERE wave = 0",
    "snapshot_sample": f"""WITH {_RAW}
SELECT {_RAW_COLUMNS} FROM raw WHERE wave = 0
ORDER BY user_id NULLS FIRST, movie_id NULLS FIRST, rating NULLS FIRST,
         timestamp NULLS FIRST
LIMIT 5""",
    "silver": f"WITH {_SILVER} SELECT {_RAW_COLUMNS} FROM silver",
    "silver_count": f"WITH {_SILVER} SELECT count(*) AS n_rows FROM silver",
    "silver_latest": f"""WITH {_EVENTS}
SELECT user_id, movie_id, max(6 - rating) AS rating, timestamp
FROM rated GROUP BY user_id, movie_id, timestamp""",
    "silver_large": f"WITH {_SILVER_LARGE} SELECT {_RAW_COLUMNS} FROM silver",
    "silver_refreshed": f"WITH {_SILVER} SELECT {_RAW_COLUMNS} FROM silver",
    "silver_with_totals": f"WITH {_SILVER} SELECT {_RAW_COLUMNS} FROM silver",
    **{f"{name}_refreshed": sql for name, sql in _reports("", _SILVER).items()},
    "dim_item": f"WITH {_ITEMS} SELECT * FROM items",
    "dim_user": f"WITH {_PROFILES} SELECT * FROM profiles",
    "dim_date": f"WITH {_SILVER}, {_FACT} {_DATES}",
    "dim_date_large": f"WITH {_SILVER_LARGE}, {_FACT} {_DATES}",
    "fact_ratings":
        f"WITH {_SILVER}, {_FACT} SELECT user_id, movie_id, date_id, rating FROM fact",
    "fact_ratings_large":
        f"WITH {_SILVER_LARGE}, {_FACT} SELECT user_id, movie_id, date_id, rating FROM fact",
    "fact_sample": f"""WITH {_SILVER}, {_FACT}
SELECT user_id, movie_id, date_id, rating FROM fact
ORDER BY user_id, movie_id, date_id, rating LIMIT 5""",
    "star_check": f"""WITH {_SILVER}, {_FACT}, {_ITEMS}, {_PROFILES},
dates AS ({_DATES})
{_STAR_CHECK}""",
    "star_check_raw": f"""WITH {_RAW},
silver AS (SELECT * FROM raw), {_FACT}, {_PROFILES},
items AS (SELECT p_partkey::INTEGER AS movie_id FROM part),
dates AS (
  SELECT strftime({_DAY}, '%Y%m%d')::INTEGER AS date_id
  FROM (SELECT DISTINCT timestamp FROM raw)
)
{_STAR_CHECK}""",
    **_reports("", _SILVER),
    "top_items_from_raw": _reports("", _SILVER)["top_items"],
    **_reports("_large", _SILVER_LARGE),
    "validate": _VALIDATED,
    "validate_bodies": _VALIDATED,
    "validate_now": "SELECT count(*) AS n_rows, count(*) AS n_current FROM events",
    "trend_by_month_unknown": f"""WITH {_EVENTS},
wrong AS (
  SELECT user_id, movie_id, timestamp, event_id % 30 = 0 AS unknown, max(rating) AS rating
  FROM rated GROUP BY user_id, movie_id, timestamp, event_id % 30 = 0
)
SELECT CASE WHEN unknown THEN 0 ELSE year({_DAY}) END::INTEGER AS year,
       CASE WHEN unknown THEN 0 ELSE month({_DAY}) END::INTEGER AS month, {_COUNT}, {_average(1)}
FROM wrong GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC""",
    "train_guard": f"""WITH {_EVENTS}
SELECT w::INTEGER AS wave, (SELECT count(*) FROM rated WHERE wave = w) > 0 AS trains
FROM unnest(range(4)) AS waves(w)""",
    "flatten_ratings": f"""WITH {_SILVER}
SELECT user_id, (row_number() OVER best)::INTEGER AS rank, movie_id, rating::FLOAT AS score
FROM silver
WINDOW best AS (PARTITION BY user_id ORDER BY rating DESC, movie_id, timestamp)
QUALIFY rank <= 5""",
    "predictions_check": f"""WITH {_SILVER},
train AS (SELECT * FROM silver WHERE {_TRAINED})
SELECT user_id, count(*) AS n_rows, 0::BIGINT AS n_off FROM silver
WHERE NOT {_TRAINED}
  AND user_id IN (SELECT user_id FROM train)
  AND movie_id IN (SELECT movie_id FROM train)
GROUP BY user_id""",
    "rmse_check": f"""WITH {_SILVER},
train AS (SELECT * FROM silver WHERE {_TRAINED})
SELECT count(*) AS n_rows, true AS agrees FROM silver
WHERE NOT {_TRAINED}
  AND user_id IN (SELECT user_id FROM train)
  AND movie_id IN (SELECT movie_id FROM train)""",
    "top_lists_check": f"""WITH {_SILVER},
offered AS (SELECT least(5, count(DISTINCT movie_id)) AS n FROM silver)
SELECT DISTINCT user_id, n AS n_items, 0::BIGINT AS n_off, 0::BIGINT AS n_better
FROM silver, offered""",
    "train_split": f"""WITH {_SILVER}
SELECT {_RAW_COLUMNS}, CASE WHEN {_TRAINED} THEN 'train' ELSE 'test' END AS part
FROM silver""",
    "prediction_rows": f"""WITH {_SILVER},
train AS (SELECT * FROM silver WHERE {_TRAINED})
SELECT {_RAW_COLUMNS} FROM silver
WHERE NOT {_TRAINED}
  AND user_id IN (SELECT user_id FROM train)
  AND movie_id IN (SELECT movie_id FROM train)""",
    "rmse_resubmitted":
        f"WITH {_EVENTS} SELECT sqrt(avg(power(2 * rating - 6, 2))) AS rmse FROM rated",
    "recommendations_pruned_check": f"""WITH {_SILVER},
offered AS (SELECT least(5, count(DISTINCT movie_id)) AS n FROM silver)
SELECT DISTINCT user_id, n AS n_items, 0 AS n_off FROM silver, offered""",
    "recommendation_counts": f"""WITH {_SILVER},
offered AS (SELECT least(5, count(DISTINCT movie_id))::INTEGER AS n FROM silver)
SELECT DISTINCT user_id, n AS n_items, n AS n_distinct, 0 AS n_rises
FROM silver, offered""",
    "rec_lookup": f"""WITH {_SILVER}, {_PROFILES},
offered AS (SELECT least(5, count(DISTINCT movie_id))::INTEGER AS n FROM silver),
known AS (SELECT DISTINCT user_id FROM silver)
SELECT p.user_id,
       CASE WHEN k.user_id IS NULL THEN 'not_found' ELSE 'success' END AS status,
       CASE WHEN k.user_id IS NULL THEN 0 ELSE n END AS n_items
FROM profiles p LEFT JOIN known k ON p.user_id = k.user_id, offered""",
    "rating_display": f"""WITH {_EVENTS}, {_ITEMS}
SELECT event_id, user_id, rated.movie_id, value / 50 AS score,
       coalesce(title, 'Unknown') AS title,
       CASE WHEN round(value / 50 / 5 * 100) > 100 THEN 99
            ELSE round(value / 50 / 5 * 100)::INTEGER END AS match_percent
FROM rated LEFT JOIN items ON items.movie_id = rated.movie_id""",
    "run_cycle": f"""WITH {_RAW}, {_CLEAN}, {_FACT}
SELECT 'bronze' AS table_name, count(*) AS n_rows FROM raw
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'dim_movie', count(*) FROM part
UNION ALL SELECT 'dim_user', count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'dim_date', count(DISTINCT date_id) FROM fact
UNION ALL SELECT 'fact_ratings', count(*) FROM fact
UNION ALL SELECT 'recommendations', count(DISTINCT user_id) FROM silver""",
}
