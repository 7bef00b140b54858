"""Column contracts of the raw inputs and of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw listings, bound by header name. The flag tells whether a null is an error.
LISTING_FIELDS: dict[str, tuple[T.DataType, bool]] = {
    "id": (T.LongType(), True),
    "name": (T.StringType(), False),
    "host_id": (T.LongType(), True),
    "host_name": (T.StringType(), False),
    "neighbourhood_group": (T.StringType(), False),
    "neighbourhood": (T.StringType(), False),
    "latitude": (T.DoubleType(), True),
    "longitude": (T.DoubleType(), True),
    "room_type": (T.StringType(), False),
    "price": (T.IntegerType(), True),
    "minimum_nights": (T.IntegerType(), True),
    "number_of_reviews": (T.IntegerType(), True),
    "last_review": (T.StringType(), False),
    "reviews_per_month": (T.DoubleType(), False),
    "calculated_host_listings_count": (T.IntegerType(), True),
    "availability_365": (T.IntegerType(), True),
}

REQUIRED_LISTING_FIELDS = [name for name, (_, required) in LISTING_FIELDS.items() if required]

CALENDAR_FIELDS = ["listing_id", "date", "available", "price"]

# Warehouse tables: name -> ordered (column, SQL type). Inserts are by position.
WAREHOUSE_TABLES: dict[str, list[tuple[str, str]]] = {
    "dim_room_type": [("room_type", "string")],
    "dim_neighbourhood": [("name", "string"), ("group", "string"), ("city", "string")],
    "dim_date": [("date", "date"), ("day", "int"), ("month", "int"), ("year", "int")],
    "dim_host": [("id", "string"), ("name", "string")],
    "tof_reviews": [
        ("id", "string"),
        ("neighbourhood", "string"),
        ("date", "date"),
        ("host_id", "string"),
        ("room_type", "string"),
        ("available_listings_count", "bigint"),
        ("not_available_listings_count", "bigint"),
        ("prices_sum", "double"),
        ("ratings_sum", "double"),
        ("declared_reviews_count", "bigint"),
    ],
}

# Key of each dimension, and the order in which the smallest row of a key is kept.
DIMENSION_KEYS: dict[str, tuple[str, list[str]]] = {
    "dim_room_type": ("room_type", []),
    "dim_neighbourhood": ("name", ["city", "group"]),
    "dim_date": ("date", ["day", "month", "year"]),
    "dim_host": ("id", ["name"]),
}

# Rows of the inputs that could not be read as they should, in the order of their columns.
REJECT_COLUMNS: list[tuple[str, str]] = [
    ("source", "string"),
    ("file", "string"),
    ("block", "bigint"),
    ("row", "bigint"),
    ("reasons", "array<string>"),
    ("raw", "string"),
    ("kept", "boolean"),
]
