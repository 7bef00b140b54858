"""The registered queries in plain SQL: row-level joins and group-bys, nothing factored out."""

from __future__ import annotations

from validation.queries import CITY, MIN_REVIEWS, MONTHS

# Columns of the pivots; a room type missing here would differ from what the queries find.
ROOM_TYPES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

_LISTINGS = """
listings AS (
  SELECT c_custkey AS id,
         'Flat "' || c_name || '",' || chr(10) || 'floor ' || c_nationkey AS name,
         c_custkey // 5 AS host_id,
         'Host#' || (c_custkey // 5) AS host_name,
         r_name || '-' || (n_nationkey % 2) AS neighbourhood_group,
         n_name AS neighbourhood,
         CAST(c_nationkey AS DOUBLE) * 1.5 AS latitude,
         CAST(c_nationkey AS DOUBLE) * -2.5 AS longitude,
         c_mktsegment AS room_type,
         CAST(round(abs(c_acctbal)) AS INTEGER) AS price,
         CAST(c_custkey % 3 + 1 AS INTEGER) AS minimum_nights,
         CAST(c_custkey % 7 + 1 AS INTEGER) AS number_of_reviews,
         CASE WHEN c_custkey % 4 > 0 THEN '1998-08-02' END AS last_review,
         CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey % 8 AS DOUBLE) / 4 END AS reviews_per_month,
         5 AS calculated_host_listings_count,
         CAST(c_custkey % 366 AS INTEGER) AS availability_365,
         r_name AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def _words(text: str) -> str:
    deleted = "'[\".?!,]'"
    return (
        f"unnest(string_split(lower(rtrim(regexp_replace({text}, {deleted}, '', 'g'), ' ')), ' '))"
    )


_LEXICON = f"""
benchmark_words AS (
  SELECT DISTINCT {_words("replace(text, chr(10), ' ')")} AS word FROM benchmark
),
lexicon AS (
  SELECT word, CAST(length(word) % 2 = 0 AS INTEGER) AS positive,
         CAST(length(word) % 2 = 1 AS INTEGER) AS negative
  FROM benchmark_words WHERE length(word) > 3
)"""

_LARGE_LEXICON = f"""
conversation_words AS (SELECT DISTINCT {_words("text")} AS word FROM conversations),
lexicon AS (
  SELECT word, CAST(length(word) % 2 = 0 AS INTEGER) AS positive,
         CAST(length(word) % 2 = 1 AS INTEGER) AS negative
  FROM conversation_words WHERE length(word) > 3
)"""


def _rated(source: str, key: str, text: str, name: str) -> str:
    """Hits and rating per text of ``source``."""
    return f"""
{name}_words AS (SELECT {key}, {_words(text)} AS word FROM {source}),
{name}_hits AS (
  SELECT {key}, CAST(coalesce(sum(positive), 0) AS BIGINT) AS positive,
         CAST(coalesce(sum(negative), 0) AS BIGINT) AS negative
  FROM {name}_words LEFT JOIN lexicon USING (word) GROUP BY {key}
),
{name} AS (
  SELECT *, CASE WHEN positive + negative = 0 THEN CAST(2.5 AS DOUBLE)
            ELSE (CAST(positive - negative AS DOUBLE) / (positive + negative) + 1) * 2.5 END AS rating
  FROM {name}_hits
)"""


_RATED_DOCUMENTS = _rated("documents", "doc_id", "text", "rated_documents")

_RATED = """
rated AS (
  SELECT o_orderkey AS review_id, o_custkey AS listing_id, CAST(o_orderdate AS DATE) AS date, rating
  FROM orders JOIN rated_documents
    ON o_orderkey % (SELECT max(doc_id) + 1 FROM documents) = doc_id
)"""

_CALENDAR = """
calendar AS (
  SELECT o_custkey AS listing_id, CAST(o_orderdate AS DATE) AS date,
         l_linestatus = 'O' AS available,
         CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_JOINED = """
joined AS (
  SELECT r.listing_id, r.date, l.neighbourhood, CAST(l.host_id AS VARCHAR) AS host_id, l.room_type,
         CASE WHEN c.listing_id IS NULL THEN true ELSE c.available END AS available,
         CASE WHEN c.listing_id IS NULL THEN CAST(l.price AS DOUBLE) ELSE c.price END AS price,
         r.rating, l.number_of_reviews
  FROM rated r JOIN listings l ON r.listing_id = l.id
  LEFT JOIN calendar c ON c.listing_id = r.listing_id AND c.date = r.date
)"""

_FACTS = """
facts AS (
  SELECT sha256(concat_ws(chr(31), neighbourhood, CAST(date AS VARCHAR), host_id, room_type)) AS id,
         neighbourhood, date, host_id, room_type,
         count(CASE WHEN available THEN 1 END) AS available_listings_count,
         count(CASE WHEN NOT available THEN 1 END) AS not_available_listings_count,
         sum(price) AS prices_sum, sum(rating) AS ratings_sum,
         CAST(sum(number_of_reviews) AS BIGINT) AS declared_reviews_count
  FROM joined GROUP BY neighbourhood, date, host_id, room_type
)"""

_DIMENSIONS = """
dim_room_type AS (SELECT DISTINCT room_type FROM listings),
dim_neighbourhood AS (
  SELECT name, "group", city FROM (
    SELECT neighbourhood AS name, neighbourhood_group AS "group", city,
           row_number() OVER (PARTITION BY neighbourhood ORDER BY city, neighbourhood_group) AS rn
    FROM listings) WHERE rn = 1
),
dim_host AS (
  SELECT CAST(host_id AS VARCHAR) AS id, min(host_name) AS name FROM listings GROUP BY host_id
),
all_dates AS (
  SELECT date FROM calendar UNION SELECT CAST(o_orderdate AS DATE) FROM orders
),
dim_date AS (
  SELECT date, CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year FROM all_dates
)"""

_AWKWARD_RECORDS = """
awkward_records AS (
  SELECT o_orderkey, o_custkey AS listing_id, CAST(o_orderdate AS DATE) AS date,
         CASE WHEN o_orderkey % 2 = 0 THEN '"' || string_split(text, '"')[1] || '"'
              ELSE string_split(text, chr(10))[1] END AS comment
  FROM documents JOIN orders ON o_orderkey % (SELECT max(doc_id) + 1 FROM documents) = doc_id
  WHERE CASE WHEN o_orderkey % 2 = 0 THEN length(string_split(text, '"')[1]) > 0
             ELSE length(string_split(text, chr(10))[1]) > 0 AND NOT starts_with(text, '"') END
)"""

_RECORDS = """
records AS (
  SELECT o_orderkey, o_custkey AS listing_id, CAST(o_orderdate AS DATE) AS date,
         CASE WHEN o_orderkey % 2 = 0 THEN '"' || replace(text, '"', chr(39)) || '"'
              ELSE translate(replace(text, '"', chr(39)),
                   chr(10) || chr(13) || chr(133) || chr(8232) || chr(8233), '     ') END AS comment
  FROM documents JOIN orders ON o_orderkey % (SELECT max(doc_id) + 1 FROM documents) = doc_id
  WHERE length(text) > 0
)"""

_RATED_RECORDS = _rated("records", "o_orderkey, listing_id, date", "comment", "rated_records")

_STAR = [_LISTINGS, _LEXICON, _RATED_DOCUMENTS, _RATED, _CALENDAR, _JOINED, _FACTS, _DIMENSIONS]

# The full load starts from the record texts instead of from one text per order.
_LOADED = [
    _LISTINGS,
    _LEXICON,
    _RECORDS,
    _RATED_RECORDS,
    "rated AS (SELECT listing_id, date, rating FROM rated_records)",
    _CALENDAR,
    _JOINED,
    _FACTS,
    _DIMENSIONS.replace(
        "SELECT CAST(o_orderdate AS DATE) FROM orders", "SELECT date FROM records"
    ),
]

_COUNT = "sum(available_listings_count + not_available_listings_count)"

_FACT_ROWS = """SELECT id, neighbourhood, date, host_id, room_type, available_listings_count,
       not_available_listings_count, round(prices_sum, 2) AS prices_sum,
       round(ratings_sum, 4) AS ratings_sum, declared_reviews_count FROM facts"""

_STAR_ROWS = """
SELECT f.neighbourhood, f.date, f.host_id, f.room_type, available_listings_count,
       not_available_listings_count, round(prices_sum, 2) AS prices_sum,
       round(ratings_sum, 4) AS ratings_sum, declared_reviews_count,
       n."group", n.city, d.day, d.month, d.year, h.name AS host_name
FROM facts f JOIN dim_neighbourhood n ON f.neighbourhood = n.name
JOIN dim_date d ON f.date = d.date JOIN dim_room_type t ON f.room_type = t.room_type
JOIN dim_host h ON f.host_id = h.id"""

_FACT_STAR = """
FROM facts f JOIN dim_neighbourhood n ON f.neighbourhood = n.name
JOIN dim_date d ON f.date = d.date JOIN dim_room_type t ON f.room_type = t.room_type"""

_REJECTS = """
SELECT 'listings' AS source, 'price missing' AS reason, true AS kept,
       count(*) FILTER (WHERE room_type = 'BUILDING') AS listed, count(*) AS counted_rows,
       count(*) FILTER (WHERE room_type = 'BUILDING') AS counted_rejected, 0 AS counted_left_out
FROM listings
UNION ALL
SELECT 'calendar', 'date malformed', false, count(*) FILTER (WHERE NOT available), count(*),
       count(*) FILTER (WHERE NOT available), count(*) FILTER (WHERE NOT available)
FROM calendar
UNION ALL
SELECT 'reviews', 'date malformed', false, count(*) FILTER (WHERE o_orderkey % 10 = 3), count(*),
       count(*) FILTER (WHERE o_orderkey % 10 = 3), count(*) FILTER (WHERE o_orderkey % 10 = 3)
FROM records"""

# Spark rounds the shortest decimal text of a double, so the SQL does the same.
_HOST_RATINGS = f"""
host_ratings AS (
  SELECT n.city, n."group", d.year, h.id, h.name,
         CAST(round(CAST(CAST(round(sum(ratings_sum) / {_COUNT}, 10) AS VARCHAR)
                         AS DECIMAL(38, 20)), 2) AS DOUBLE) AS avg_rating,
         CAST({_COUNT} AS BIGINT) AS number_of_reviews
  FROM facts f JOIN dim_neighbourhood n ON f.neighbourhood = n.name
  JOIN dim_date d ON f.date = d.date JOIN dim_host h ON f.host_id = h.id
  GROUP BY n.city, n."group", d.year, h.id, h.name
),
latest AS (
  SELECT r.* FROM host_ratings r
  WHERE year = (SELECT max(year) FROM host_ratings m WHERE m.city = r.city)
    AND number_of_reviews > {MIN_REVIEWS}
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY city, "group" ORDER BY avg_rating DESC, number_of_reviews, id) AS rn
  FROM latest
)"""


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _by_room_type(value: str, digits: int | None = None) -> str:
    cells = []
    for name in ROOM_TYPES:
        cell = value.replace("@", f"FILTER (WHERE f.room_type = '{name}')")
        cell = f"round({cell}, {digits})" if digits else f"CAST({cell} AS BIGINT)"
        cells.append(f'{cell} AS "{name}"')
    return ", ".join(cells)


def _star(select: str) -> str:
    return _with(_STAR, select)


def all_oracle_sql() -> dict[str, str]:
    reviews = _by_room_type(f"{_COUNT} @")
    prices = _by_room_type(f"sum(prices_sum) @ / {_COUNT} @", 6)
    months = ", ".join(map(str, MONTHS))
    hosts = [*_STAR, _HOST_RATINGS]
    best = 'SELECT "group" AS neighbourhood, name, avg_rating, number_of_reviews FROM ranked'
    records = "SELECT listing_id, date, comment FROM records"
    calendar_rows = """SELECT CAST(listing_id AS BIGINT) AS listing_id, date, available,
        round(price, 2) AS price FROM calendar"""
    required = [
        "id",
        "host_id",
        "latitude",
        "longitude",
        "minimum_nights",
        "number_of_reviews",
        "calculated_host_listings_count",
        "availability_365",
    ]
    nulls = ", ".join(f"count(*) - count({name}) AS {name}" for name in required)
    return {
        "scan_listings_csv": _with([_LISTINGS], "SELECT * FROM listings"),
        "scan_listings_csv_whole": _with([_LISTINGS], "SELECT * FROM listings"),
        "scan_calendar_csv": _with([_CALENDAR], calendar_rows),
        "scan_review_text_whole": _with([_RECORDS], records),
        "scan_review_text_split": _with([_RECORDS], records),
        "load_lexicon": _with([_LEXICON], "SELECT word, positive, negative FROM lexicon"),
        "parse_money": """SELECT l_orderkey,
            CASE WHEN l_returnflag <> 'R' THEN round(l_extendedprice, 2) END AS price
            FROM lineitem""",
        "parse_flag": "SELECT l_orderkey, l_linestatus = 'O' AS available FROM lineitem",
        "parse_date_parts": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
            CAST(day(o_orderdate) AS INTEGER) AS day, CAST(month(o_orderdate) AS INTEGER) AS month,
            CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
        "review_extract": _with(
            [_AWKWARD_RECORDS], "SELECT listing_id, date, comment FROM awkward_records"
        ),
        "required_nulls": _with(
            [_LISTINGS],
            f"""SELECT count(*) AS rows, {nulls},
            count(*) FILTER (WHERE room_type = 'BUILDING') AS price FROM listings""",
        ),
        "strict_listings": _with(
            [_LISTINGS], "SELECT id, host_id, price, number_of_reviews FROM listings"
        ),
        "rejected_rows": _with(
            [_CALENDAR],
            """SELECT CAST(listing_id AS VARCHAR) AS listing_id, '2018-1-2' AS date,
            'f' AS available FROM calendar WHERE NOT available""",
        ),
        "sentiment_rating": _with(
            [_LEXICON, _RATED_DOCUMENTS],
            "SELECT doc_id, positive, negative, round(rating, 10) AS rating FROM rated_documents",
        ),
        "sentiment_large_lexicon": _with(
            [_LARGE_LEXICON, _RATED_DOCUMENTS],
            "SELECT doc_id, positive, negative, round(rating, 10) AS rating FROM rated_documents",
        ),
        "rate_extracted_reviews": _with(
            [_LEXICON, _RECORDS, _RATED_RECORDS],
            "SELECT listing_id, date, round(rating, 10) AS rating FROM rated_records",
        ),
        "dim_room_type": _with([_LISTINGS], "SELECT DISTINCT room_type FROM listings"),
        "dim_host": _with(
            [_LISTINGS, _CALENDAR, _DIMENSIONS], "SELECT id, name FROM dim_host"
        ),
        "dim_neighbourhood": _with(
            [_LISTINGS, _CALENDAR, _DIMENSIONS], 'SELECT name, "group", city FROM dim_neighbourhood'
        ),
        "dim_date": _with(
            [_LISTINGS, _CALENDAR, _DIMENSIONS], "SELECT date, day, month, year FROM dim_date"
        ),
        "join_reviews_listings": _with(
            [_LISTINGS, _LEXICON, _RATED_DOCUMENTS, _RATED],
            """SELECT listing_id, review_id, date, round(rating, 10) AS rating, neighbourhood,
            CAST(host_id AS VARCHAR) AS host_id, room_type, CAST(price AS DOUBLE) AS price,
            number_of_reviews, count(*) AS copies FROM rated JOIN listings ON listing_id = id
            GROUP BY ALL""",
        ),
        "left_join_calendar": _with(
            _STAR[:6],
            """SELECT listing_id, date, available, price, count(*) AS joined_rows
            FROM joined GROUP BY listing_id, date, available, price""",
        ),
        "fact_reviews": _star(_FACT_ROWS),
        "star_joined": _star(_STAR_ROWS),
        "reviews_by_year_pivot": _star(
            f"SELECT n.city, d.year, {reviews} {_FACT_STAR} GROUP BY n.city, d.year"
        ),
        "reviews_by_year_city": _star(
            f"SELECT d.year, {reviews} {_FACT_STAR} WHERE n.city = '{CITY}' GROUP BY d.year"
        ),
        "reviews_by_year_discovered": _star(
            f"""SELECT n.city, d.year, f.room_type, CAST({_COUNT} AS BIGINT) AS reviews
            {_FACT_STAR} GROUP BY n.city, d.year, f.room_type"""
        ),
        "avg_price_by_month_pivot": _star(
            f"""SELECT n.city, d.month, {prices} {_FACT_STAR}
            WHERE d.month IN ({months}) GROUP BY n.city, d.month"""
        ),
        "avg_price_by_month_city": _star(
            f"""SELECT d.month, {prices} {_FACT_STAR}
            WHERE d.month IN ({months}) AND n.city = '{CITY}' GROUP BY d.month"""
        ),
        "host_ratings": _with(hosts, "SELECT * FROM host_ratings"),
        "latest_year_hosts": _with(hosts, "SELECT * FROM latest"),
        "top_hosts_per_group": _with(
            hosts, best.replace("SELECT", "SELECT city,") + " WHERE rn <= 2"
        ),
        "top_hosts_city": _with(hosts, f"{best} WHERE rn <= 2 AND city = '{CITY}'"),
        "top_hosts_sql": _with(hosts, f"{best} WHERE rn <= 2 AND city = '{CITY}'"),
        "top_hosts_sql_all": _with(
            hosts, best.replace("SELECT", "SELECT city,") + " WHERE rn <= 2"
        ),
        "warehouse_roundtrip": _star(_FACT_ROWS),
        "warehouse_append": _with(
            [_LISTINGS, _CALENDAR, _DIMENSIONS],
            """SELECT name, "group", city FROM dim_neighbourhood
            UNION ALL SELECT name, "group", city FROM dim_neighbourhood""",
        ),
        "warehouse_full_load": _with(_LOADED, _STAR_ROWS),
        "warehouse_merge_load": _with(_LOADED, _STAR_ROWS),
        "warehouse_rejects": _with([_LISTINGS, _CALENDAR, _RECORDS], _REJECTS),
        "warehouse_by_city": _with(
            [_LISTINGS, _LEXICON, _RATED_DOCUMENTS, _RATED, _CALENDAR],
            """SELECT l.city, 'District ' || (l.id % 4) AS neighbourhood,
            l.city || '/District ' || (l.id % 4) AS "group", CAST(year(r.date) AS INTEGER) AS year,
            count(*) AS reviews,
            round(sum(CASE WHEN c.listing_id IS NULL THEN CAST(l.price AS DOUBLE) ELSE c.price END), 2)
                AS prices
            FROM rated r JOIN listings l ON r.listing_id = l.id
            LEFT JOIN calendar c ON c.listing_id = r.listing_id AND c.date = r.date
            GROUP BY ALL""",
        ),
        "warehouse_run_ids": _star("SELECT 2 * count(*) AS facts, 2 * count(*) AS ids FROM facts"),
    }
