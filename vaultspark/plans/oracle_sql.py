"""DuckDB SQL oracles for the registered queries.

Each oracle computes its result straight from the driver tables (``region
nation customer supplier part orders lineitem events ...``), by a route that
does not pass through JSON text, so it checks the shredding too.  The fixture
recipes are restated here in SQL; fixed values: first day 2024-01-01, test day
D = 2024-01-05, 30 business days, 25 couriers, open version 2099-12-01.
"""

from __future__ import annotations

D = "DATE '2024-01-05'"
D1 = "DATE '2024-01-04'"
OPEN = "TIMESTAMP '2099-12-01 00:00:00'"


def _at(day: str, k: str) -> str:
    return f"(TIMESTAMP '{day}' + to_hours(CAST({k} % 24 AS INTEGER)))"


ODATE = "(TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INTEGER)) + to_hours(CAST(o_orderkey % 24 AS INTEGER)))"
NS = "(SELECT count(*) FROM supplier)"

CTE = {
    "ord": f"ord AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {ODATE} AS odate FROM orders)",
    "items": "items AS (SELECT l_orderkey, l_partkey, CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) AS quantity "
             "FROM lineitem GROUP BY l_orderkey, l_partkey)",
    "bon": "bon AS (SELECT l_orderkey, l_partkey, "
           "CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) * 0.05 AS DECIMAL(8,2)) AS bonus_payment, "
           "CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) * 0.01 AS DECIMAL(8,2)) AS bonus_grant "
           "FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey, l_partkey)",
    "orest": "orest AS (SELECT l_orderkey, min(l_suppkey) AS rkey FROM lineitem GROUP BY l_orderkey)",
    "deliv": "deliv AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, odate AS order_ts, "
             "'d' || CAST(o_orderkey AS VARCHAR) AS delivery_id, CAST(o_orderkey % 25 AS VARCHAR) AS courier_id, "
             "'Street ' || CAST(o_custkey AS VARCHAR) AS address, "
             "odate + to_minutes(CAST(20 + o_orderkey % 60 AS INTEGER)) AS delivery_ts, "
             "CAST(1 + o_orderkey % 5 AS SMALLINT) AS rate, CAST(o_totalprice AS DECIMAL(14,2)) AS sum, "
             "CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 0.01 AS DECIMAL(8,2)) AS tip_sum "
             "FROM ord WHERE o_orderstatus <> 'O')",
    "users1": f"users1 AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS bk, c_name AS name, "
              f"lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) AS login, {_at('2024-01-01', 'c_custkey')} AS update_ts "
              f"FROM customer)",
    "users2": f"users2 AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS bk, "
              f"CASE WHEN c_custkey % 12 = 6 THEN c_name || ' v2' ELSE c_name END AS name, "
              f"lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 12 = 0 THEN '_2' ELSE '' END AS login, "
              f"{_at('2024-01-02', 'c_custkey')} AS update_ts FROM customer WHERE c_custkey % 3 = 0)",
    "rest1": f"rest1 AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS bk, s_name AS name, "
             f"{_at('2024-01-01', 's_suppkey')} AS update_ts FROM supplier)",
    "rest2": f"rest2 AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS bk, "
             f"CASE WHEN s_suppkey % 6 = 0 THEN s_name || ' v2' ELSE s_name END AS name, "
             f"{_at('2024-01-02', 's_suppkey')} AS update_ts FROM supplier WHERE s_suppkey % 3 = 0)",
    "prod1": f"prod1 AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS bk, p_name AS name, "
             f"CAST(p_retailprice AS DECIMAL(8,2)) AS price, p_type AS category, "
             f"{_at('2024-01-01', f'(p_partkey % {NS})')} AS update_ts FROM part)",
    "prod2": f"prod2 AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS bk, p_name AS name, "
             f"CASE WHEN p_partkey % 2 = 0 THEN CAST(CAST(p_retailprice AS DECIMAL(8,2)) + 1.00 AS DECIMAL(8,2)) "
             f"ELSE CAST(p_retailprice AS DECIMAL(8,2)) END AS price, p_type AS category, "
             f"{_at('2024-01-02', f'(p_partkey % {NS})')} AS update_ts FROM part WHERE (p_partkey % {NS}) % 3 = 0)",
    "bonus_orders": "bonus_orders AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag <> 'R')",
    "outbox": "outbox AS (SELECT event_type, ts AS event_ts, CAST(NULL AS VARCHAR) AS order_id FROM events "
              "UNION ALL SELECT 'bonus_transaction', odate, CAST(o_orderkey AS VARCHAR) FROM ord "
              "WHERE o_orderkey IN (SELECT l_orderkey FROM bonus_orders))",
    "wlog": "wlog AS (SELECT 'orders' AS table_name, max(odate) AS update_ts FROM ord "
            "WHERE odate < TIMESTAMP '2024-01-05' GROUP BY CAST(odate AS DATE) "
            "UNION ALL SELECT 'restaurants', max(update_ts) FROM rest1 "
            "UNION ALL SELECT 'restaurants', max(update_ts) FROM rest2 "
            "UNION ALL SELECT 'users', max(update_ts) FROM users1)",
    "sorders": "sorders AS (SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS order_id_dwh, d.tip_sum AS order_tip_sum, "
               "d.rate AS order_rate, o_orderstatus AS order_status, d.address AS order_address, "
               "odate AS order_create_ts, d.delivery_ts AS order_delivering_ts "
               f"FROM ord LEFT JOIN deliv d ON d.order_id = CAST(o_orderkey AS VARCHAR) "
               f"WHERE CAST(odate AS DATE) BETWEEN {D1} AND {D})",
    "link": "link AS (SELECT sha256(CAST(o.o_orderkey AS VARCHAR)) AS order_id_dwh, "
            "sha256(CAST(r.rkey AS VARCHAR)) AS restaurant_id_dwh, sha256(CAST(o.o_custkey AS VARCHAR)) AS user_id_dwh, "
            "CASE WHEN o.o_orderstatus <> 'O' THEN sha256(CAST(o.o_orderkey % 25 AS VARCHAR)) END AS courier_id_dwh, "
            "sha256(CAST(i.l_partkey AS VARCHAR)) AS product_id_dwh, i.quantity, b.bonus_payment, b.bonus_grant, "
            "CAST(o.odate AS DATE) AS _day "
            "FROM ord o JOIN items i ON i.l_orderkey = o.o_orderkey "
            "JOIN bon b ON b.l_orderkey = i.l_orderkey AND b.l_partkey = i.l_partkey "
            "JOIN orest r ON r.l_orderkey = o.o_orderkey "
            "JOIN supplier s ON s.s_suppkey = r.rkey JOIN customer c ON c.c_custkey = o.o_custkey "
            "JOIN part p ON p.p_partkey = i.l_partkey)",
}
DEPS = {"items": [], "deliv": ["ord"], "outbox": ["ord", "bonus_orders"], "wlog": ["ord", "rest1", "rest2", "users1"],
        "sorders": ["ord", "deliv"], "link": ["ord", "items", "bon", "orest"]}


def sql(body: str, *ctes: str) -> str:
    """``WITH <ctes and their dependencies> <body>``."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for c in ctes:
        add(c)
    if not order:
        return body
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n" + body


# SCD2 satellites after v1 (day 1) and v2 (day 2), as SQL over the recipes.
def scd2_two_days(v1: str, v2: str, key: str, cols: list[tuple[str, str]]) -> str:
    """Versions after loading ``v1`` then ``v2``: a v2 row that differs in any attribute
    closes the v1 version at its update time - 1 ms and opens a new one."""
    diff = " OR ".join(f"a.{src} <> b.{src}" for src, _ in cols)
    sel_a = ", ".join(f"a.{src} AS {dst}" for src, dst in cols)
    sel_b = ", ".join(f"b.{src} AS {dst}" for src, dst in cols)
    return sql(
        f"SELECT sha256(a.bk) AS {key}, {sel_a}, a.update_ts AS active_from, "
        f"CASE WHEN b.bk IS NOT NULL AND ({diff}) THEN b.update_ts - INTERVAL 1 MILLISECOND ELSE {OPEN} END AS active_to "
        f"FROM {v1} a LEFT JOIN {v2} b ON a.bk = b.bk "
        f"UNION ALL SELECT sha256(b.bk), {sel_b}, b.update_ts, {OPEN} "
        f"FROM {v1} a JOIN {v2} b ON a.bk = b.bk WHERE {diff}",
        v1, v2)
