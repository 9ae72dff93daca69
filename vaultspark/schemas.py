"""Declared tables of the warehouse (staging + hub/link/satellite layer).

Plain parquet enforces none of these declarations; the keys and rules here
feed the data-quality operators (``operators.quality``) and ``store.empty_table``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, INT, SHORT = T.StringType(), T.TimestampNTZType(), T.IntegerType(), T.ShortType()
DEC8, DEC14 = T.DecimalType(8, 2), T.DecimalType(14, 2)


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


DOCUMENT = _schema(("object_id", S), ("object_value", S), ("update_ts", TS))

STAGING = {
    "order_system_restaurants": DOCUMENT,
    # Staged orders also carry their business date (derived from the JSON on
    # staging) so day slices prune by column; the store partitions by it.
    "order_system_orders": T.StructType(DOCUMENT.fields + [T.StructField("order_date", T.DateType(), True)]),
    "order_system_users": DOCUMENT,
    "bonus_system_users": _schema(("bonus_user_id", INT), ("order_user_id", S)),
    # Bonus transactions carry their order's business date, which the store's files are filtered by.
    "bonus_system_outbox": _schema(("event_type", S), ("event_value", S), ("event_ts", TS), ("order_date", T.DateType())),
    "couriers_system_couriers": _schema(("_id", S), ("name", S)),
    "couriers_system_deliveries": _schema(
        ("order_id", S), ("order_ts", TS), ("delivery_id", S), ("courier_id", S),
        ("address", S), ("delivery_ts", TS), ("rate", SHORT), ("sum", DEC14), ("tip_sum", DEC8),
    ),
    "load_watermarks": _schema(("table_name", S), ("update_ts", TS)),
}


def hub_schema(entity: str) -> T.StructType:
    return _schema((f"{entity}_id_dwh", S), (f"{entity}_id_bk", S))


HUB_ENTITIES = ("restaurant", "user", "courier", "order", "product")

VAULT = {f"h_{e}s": hub_schema(e) for e in HUB_ENTITIES}
VAULT.update({
    "l_orders": _schema(
        ("order_id_dwh", S), ("restaurant_id_dwh", S), ("user_id_dwh", S), ("courier_id_dwh", S),
        ("product_id_dwh", S), ("quantity", INT), ("bonus_payment", DEC8), ("bonus_grant", DEC8),
    ),
    "s_restaurants": _schema(("restaurant_id_dwh", S), ("restaurant_name", S), ("active_from", TS), ("active_to", TS)),
    "s_products": _schema(
        ("product_id_dwh", S), ("product_name", S), ("product_price", DEC8), ("product_category", S),
        ("active_from", TS), ("active_to", TS),
    ),
    "s_users": _schema(("user_id_dwh", S), ("user_name", S), ("user_login", S), ("active_from", TS), ("active_to", TS)),
    "s_couriers": _schema(("courier_id_dwh", S), ("courier_name", S), ("active_from", TS), ("active_to", TS)),
    "s_orders": _schema(
        ("order_id_dwh", S), ("order_tip_sum", DEC8), ("order_rate", SHORT), ("order_status", S),
        ("order_address", S), ("order_create_ts", TS), ("order_delivering_ts", TS),
    ),
})

TABLES = {**STAGING, **VAULT}

# Tables a run keeps for itself, beside those it loads.
BOOKKEEPING = {
    # Orders whose business date changed: which partitions may hold rows loaded under an earlier date.
    "order_moves": _schema(("object_id", S), ("old_day", T.DateType()), ("new_day", T.DateType())),
    # One row per table of a finished run, all written at once, after everything else.
    "run_ledger": _schema(("run_id", T.LongType()), ("run_day", T.DateType()), ("table_name", S), ("kind", S), ("path", S),
                          ("buckets", INT), ("rows", T.LongType())),
}

# Physical layout of persisted tables (partition columns).
PARTITIONING = {"order_system_orders": ["order_date"]}

# Declared constraints, as data.  Rule kinds: not_null, unique, foreign_key,
# lower_bound, range, max_length.  Fixed values of the warehouse model.
RULES = {
    "order_system_orders": [("not_null", ["object_id", "object_value", "update_ts"]), ("unique", ["object_id"]),
                            ("max_length", "object_id", 24)],
    "order_system_restaurants": [("not_null", ["object_id", "object_value", "update_ts"]), ("unique", ["object_id"]),
                                 ("max_length", "object_id", 24)],
    "order_system_users": [("not_null", ["object_id", "object_value", "update_ts"]), ("unique", ["object_id"]),
                           ("max_length", "object_id", 24)],
    "couriers_system_deliveries": [
        ("not_null", ["order_id", "order_ts", "delivery_id", "courier_id", "address", "delivery_ts", "rate", "sum", "tip_sum"]),
        ("max_length", "address", 50),
    ],
    "bonus_system_users": [("not_null", ["bonus_user_id"]), ("unique", ["bonus_user_id"])],
    "l_orders": [
        ("not_null", ["order_id_dwh", "restaurant_id_dwh", "user_id_dwh", "product_id_dwh",
                      "quantity", "bonus_payment", "bonus_grant"]),
        ("unique", ["order_id_dwh", "product_id_dwh"]),
        ("lower_bound", "quantity", 0, False),
        ("lower_bound", "bonus_payment", 0, True),
        ("lower_bound", "bonus_grant", 0, True),
    ],
    "s_restaurants": [("not_null", ["restaurant_id_dwh", "restaurant_name", "active_from", "active_to"]),
                      ("max_length", "restaurant_name", 100)],
    "s_products": [("not_null", ["product_id_dwh", "product_name", "product_price", "product_category",
                                 "active_from", "active_to"]),
                   ("lower_bound", "product_price", 0, True),
                   ("max_length", "product_name", 100), ("max_length", "product_category", 100)],
    "s_users": [("not_null", ["user_id_dwh", "user_name", "user_login", "active_from", "active_to"]),
                ("max_length", "user_name", 100), ("max_length", "user_login", 25)],
    "s_couriers": [("not_null", ["courier_name"]), ("max_length", "courier_name", 100)],
    "s_orders": [
        ("not_null", ["order_id_dwh", "order_rate", "order_status", "order_create_ts"]),
        ("unique", ["order_id_dwh"]),
        ("lower_bound", "order_tip_sum", 0, True),
        ("range", "order_rate", 1, 5),
        ("max_length", "order_status", 9),
        ("max_length", "order_address", 50),
    ],
}
for _e in HUB_ENTITIES:
    RULES[f"h_{_e}s"] = [("not_null", [f"{_e}_id_dwh", f"{_e}_id_bk"]), ("unique", [f"{_e}_id_bk"]),
                         ("max_length", f"{_e}_id_bk", 24)]

# Declared references: table -> column -> hub (whose surrogate key has the column's name).
FOREIGN_KEYS = {
    "l_orders": {f"{_e}_id_dwh": f"h_{_e}s" for _e in ("order", "restaurant", "user", "courier", "product")},
    **{f"s_{_e}s": {f"{_e}_id_dwh": f"h_{_e}s"} for _e in HUB_ENTITIES},
}

# Column defaults of the declared tables (applied only on request).
DEFAULTS = {
    "l_orders": {"quantity": 1, "bonus_payment": "0", "bonus_grant": "0"},
    "s_products": {"product_price": "0", "product_category": "General"},
    "s_orders": {"order_tip_sum": "0", "order_rate": 5},
}
