"""Source frames, staging tables and hub states derived from the driver tables.

Shared by the registered queries, the tests and the bench.  Everything is
lazy; building a ``World`` reads no data.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from vaultspark.functions.json import to_document, to_order_document
from vaultspark.functions.time import in_days, previous_day
from vaultspark.operators import vault
from vaultspark.operators.shred import menu_product_keys
from vaultspark.sources import fixtures as fx
from vaultspark.session import shared_dir
from vaultspark.sources.store import empty_table, save_table

D = fx.TEST_DAY


class World:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = fx.Tables(spark, sf_dir)

    # -------------------------------------------------- sources
    @cached_property
    def orders_source(self) -> DataFrame:
        return fx.orders_source(self.t)

    @cached_property
    def restaurants_v1(self) -> DataFrame:
        return fx.restaurants_v1(self.t)

    @cached_property
    def restaurants_v2(self) -> DataFrame:
        return fx.restaurants_v2(self.t)

    @cached_property
    def users_v1(self) -> DataFrame:
        return fx.users_v1(self.t)

    @cached_property
    def users_v2(self) -> DataFrame:
        return fx.users_v2(self.t)

    @cached_property
    def outbox(self) -> DataFrame:
        return fx.outbox(self.t)

    @cached_property
    def deliveries(self) -> DataFrame:
        return fx.deliveries(self.t)

    @cached_property
    def couriers(self) -> DataFrame:
        return fx.couriers(self.t)

    def sources(self) -> dict[str, DataFrame]:
        """Source systems as the daily pipeline sees them (documents hold every version)."""
        return {
            "orders": self.orders_source,
            "restaurants": self.restaurants_v1.unionByName(self.restaurants_v2),
            "users": self.users_v1.unionByName(self.users_v2),
            "outbox": self.outbox,
            "bonus_users": fx.bonus_users(self.t),
            "couriers": self.couriers,
            "deliveries": self.deliveries,
        }

    def changing_sources(self) -> dict[str, DataFrame]:
        """The same with orders that change after their business day."""
        return self.sources() | {"orders": fx.changed_orders_source(self.t),
                                 "outbox": self.outbox.unionByName(fx.moved_bonus_events(self.t))}

    # -------------------------------------------------- staging
    @cached_property
    def stg_orders(self) -> DataFrame:
        return to_order_document(self.orders_source)

    @cached_property
    def stg_restaurants_v1(self) -> DataFrame:
        return to_document(self.restaurants_v1)

    @cached_property
    def stg_restaurants_v2(self) -> DataFrame:
        return to_document(self.restaurants_v2)

    @cached_property
    def stg_users_v1(self) -> DataFrame:
        return to_document(self.users_v1)

    @cached_property
    def stg_users_v2(self) -> DataFrame:
        return to_document(self.users_v2)

    # -------------------------------------------------- hubs
    def empty(self, name: str) -> DataFrame:
        return empty_table(self.spark, name)

    def persisted(self, df: DataFrame, name: str) -> DataFrame:
        """A table as a daily run leaves it: written, then read back, so the plans that
        use it start from files (as link and satellite loads read saved hubs)."""
        return save_table(df, shared_dir(self.spark, "tables"), name)

    def order_hub(self, lo=None, hi=None, key: str = "hash") -> DataFrame:
        """Order hub after loading the update days ``lo..hi`` (all days when ``lo`` is None)."""
        stg = self.stg_orders if lo is None else self.stg_orders.where(in_days("update_ts", lo, hi or lo))
        return self.persisted(vault.load_hub(self.empty("h_orders"), stg, "object_id", "order", key), "h_orders")

    @cached_property
    def restaurant_hub(self) -> DataFrame:
        stg = self.stg_restaurants_v1.where(in_days("update_ts", fx.FIRST_DAY))
        return self.persisted(vault.load_hub(self.empty("h_restaurants"), stg, "object_id", "restaurant"),
                              "h_restaurants")

    @cached_property
    def user_hub(self) -> DataFrame:
        stg = self.stg_users_v1.where(in_days("update_ts", fx.FIRST_DAY))
        return self.persisted(vault.load_hub(self.empty("h_users"), stg, "object_id", "user"), "h_users")

    @cached_property
    def product_hub(self) -> DataFrame:
        keys = menu_product_keys(self.stg_restaurants_v1, fx.FIRST_DAY)
        return self.persisted(vault.load_hub(self.empty("h_products"), keys, "product_id", "product"), "h_products")

    @cached_property
    def courier_hub(self) -> DataFrame:
        return self.persisted(vault.load_hub(self.empty("h_couriers"), self.couriers, "_id", "courier"),
                              "h_couriers")

    def hubs(self, order_hub: DataFrame) -> dict[str, DataFrame]:
        return {"order": order_hub, "restaurant": self.restaurant_hub, "user": self.user_hub,
                "product": self.product_hub, "courier": self.courier_hub}

    def hubs_for_day(self, day: str = D, days_back: int = 0) -> dict[str, DataFrame]:
        return self.hubs(self.order_hub(previous_day(day, days_back), day))
