"""The README quick start, run as written."""

import datetime as dt

from pyspark.sql import functions as F

from martkit.operators.facts import new_rows
from martkit.operators.lookup import Lookup, resolve_keys
from martkit.operators.scd import scd2_apply, seed_dimension
from martkit.sources.store import SnapshotStore


def test_readme_quick_start(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root + "/mart")
    seed = spark.createDataFrame([(1, "a", "X")], "customer_id int, name string, segment string")
    store.publish("DimCustomer", seed_dimension(seed, ["customer_id"], "CustomerKey", eff_col="EffectiveDate",
                                                 exp_col="ExpirationDate", cur_col="CurrentFlag"))
    store.publish("FactOrders", spark.createDataFrame(
        [], "order_id int, customer_id int, order_date date, CustomerKey bigint"))
    staged_customers = spark.createDataFrame([(1, "a", "Y"), (2, "b", "X")],
                                             "customer_id int, name string, segment string")
    staged_orders = spark.createDataFrame([(10, 1, dt.date(2024, 7, 1)), (11, 3, dt.date(2024, 7, 1))],
                                          "order_id int, customer_id int, order_date date")

    dim = store.read("DimCustomer")
    dim_next = scd2_apply(dim, staged_customers, ["customer_id"], ["name", "segment"], "2024-06-01", "CustomerKey")
    store.publish("DimCustomer", dim_next)
    orders = resolve_keys(staged_orders, [
        Lookup(store.read("DimCustomer"), [("customer_id", "customer_id")], "CustomerKey", "CustomerKey",
               asof=F.col("order_date"))])
    store.append("FactOrders", new_rows(store.read("FactOrders"), orders, ["order_id"]))
    store.append("FactOrders", new_rows(store.read("FactOrders"), orders, ["order_id"]))  # rerun adds nothing

    assert sorted((r.order_id, r.CustomerKey) for r in store.read("FactOrders").collect()) == [(10, 2), (11, -1)]
    assert sorted((r.customer_id, r.CustomerKey, r.CurrentFlag) for r in store.read("DimCustomer").collect()) == \
        [(1, 1, False), (1, 2, True), (2, 3, True)]
