"""Property tests: split batches and reruns give the same tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from vaultspark.operators import vault, writes

KEYS = st.lists(st.sampled_from([str(i) for i in range(12)]) | st.none(), min_size=0, max_size=15)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=KEYS, cut=st.integers(min_value=0, max_value=15))
def test_hub_is_the_same_for_any_split_of_the_batch(spark, keys, cut):
    batch = spark.createDataFrame([(k,) for k in keys], "object_id string")
    first = spark.createDataFrame([(k,) for k in keys[:cut]], "object_id string")
    rest = spark.createDataFrame([(k,) for k in keys[cut:]], "object_id string")
    empty = spark.createDataFrame([], "order_id_dwh string, order_id_bk string")
    once = vault.load_hub(empty, batch, "object_id", "order")
    split = vault.load_hub(vault.load_hub(empty, first, "object_id", "order"), rest, "object_id", "order")
    assert rows(once) == rows(split)
    assert rows(vault.load_hub(once, batch, "object_id", "order")) == rows(once)  # rerun adds nothing
    assert sorted(r.order_id_bk for r in once.collect()) == sorted({k for k in keys if k is not None})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(updates=st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 5), st.integers(0, 3)), max_size=12))
def test_upsert_is_rerun_safe_and_keeps_the_newest(spark, updates):
    schema = "object_id string, object_value string, update_ts timestamp_ntz"
    data = [(k, f"v{v}", f"2024-01-0{t + 1} 00:00:00") for k, v, t in updates]
    batch = spark.createDataFrame(data, "object_id string, object_value string, update_ts string") \
        .selectExpr("object_id", "object_value", "cast(update_ts as timestamp_ntz) as update_ts")
    target = spark.createDataFrame([], schema)
    once = writes.upsert(target, batch, ["object_id"])
    assert rows(writes.upsert(once, batch, ["object_id"])) == rows(once)
    newest = {}
    for k, v, t in updates:
        newest[k] = max(newest.get(k, (-1, "")), (t, f"v{v}"))
    assert {r.object_id: (r.update_ts.day - 1, r.object_value) for r in once.collect()} == newest
