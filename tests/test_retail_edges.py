"""Hand-made edge cases for the retail reports and equivalences between variants."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import SF_ORACLE
from tessera.operators import retail as R
from tessera.sources.retail_model import RetailModel

D = dt.date


@pytest.fixture(scope="module")
def tiny(spark):
    customers = spark.createDataFrame([
        (1, "Ann", "A", "a@x", "Gold", D(2020, 1, 15)),
        (2, "Bob", None, "b@x", "Gold", D(2020, 1, 20)),
        (3, "Cy", "C", "c@x", "Silver", D(2020, 2, 3)),
        (4, "Di", "D", "d@x", "Silver", D(2020, 3, 9)),  # never orders
    ], "customer_id long, first_name string, last_name string, email string, loyalty_tier string, "
       "registration_date date")
    orders = spark.createDataFrame([
        (10, 1, D(2020, 1, 20), "Delivered", 100.0, 0),
        (11, 1, D(2020, 3, 2), "Cancelled", 50.0, 1),
        (12, 2, D(2020, 1, 25), "Pending", 30.0, 0),
        (13, 3, D(2020, 2, 10), "Delivered", 70.0, 1),
        (14, 3, D(2020, 4, 1), "Delivered", 20.0, 1),
    ], "order_id long, customer_id long, order_date date, order_status string, total_amount double, "
       "warehouse_id long")
    products = spark.createDataFrame([
        (1, "p1", 1, "c1", 5, 10, 2.0, 10.0),
        (2, "p2", 1, "c1", 50, 10, 3.0, None),
        (3, "p3", 2, None, 0, 4, 1.0, 5.0),  # no category, no stock rows, never sold
    ], "product_id long, product_name string, supplier_id long, category_id string, stock_quantity int, "
       "reorder_level int, cost_price double, list_price double")
    items = spark.createDataFrame([
        ("i1", 10, 1, 2, 8.0, 16.0, None, 2.0, 0),
        ("i2", 10, 2, 1, 9.0, 9.0, -5, 0.0, 1),
        ("i3", 12, 1, 3, None, 24.0, 35, None, 0),
        ("i4", 13, 2, 1, 0.0, 0.0, 10, 1.0, 1),
    ], "order_item_id string, order_id long, product_id long, quantity int, unit_price double, "
       "subtotal double, discount_pct int, discount_amount double, warehouse_id long")
    return dict(customers=customers, orders=orders, products=products, items=items)


def test_inactive_customer_never_ordered_has_null_days(spark, tiny):
    rows = {r.customer_id: r for r in R.inactive_customers(tiny["customers"], tiny["orders"],
                                                           D(2020, 3, 1), D(2020, 5, 1)).collect()}
    assert rows[4].days_since_order is None and rows[4].last_order_date is None
    assert set(rows) == {2, 4}
    anti = {r.customer_id for r in R.inactive_customers_anti(tiny["customers"], tiny["orders"], D(2020, 3, 1)).collect()}
    assert anti == set(rows)


def test_concat_with_null_is_null(spark, tiny):
    r = {x.customer_id: x for x in R.top_customers(tiny["customers"], tiny["orders"]).collect()}
    # mean total over 4 customers (zero spender included) = 270 / 4 = 67.5
    assert set(r) == {1, 3}
    assert r[1].total_spent == 150.0 and r[1].total_orders == 2


def test_cohort_without_activity_keeps_one_null_row(spark, tiny):
    rows = R.cohort_retention(tiny["customers"], tiny["orders"]).collect()
    march = [r for r in rows if r.cohort_month == "2020-03-01"]
    assert len(march) == 1 and march[0].cohort_index is None and march[0].active_customers is None
    jan0 = [r for r in rows if r.cohort_month == "2020-01-01" and r.cohort_index == 0][0]
    assert (jan0.cohort_size, jan0.active_customers, jan0.retention_pct) == (2, 2, 100.0)


def test_churn_drops_months_without_previous_activity(spark, tiny):
    rows = {r.month: r for r in R.monthly_churn(tiny["orders"]).collect()}
    # months with orders: Jan, Feb, Mar (only Cancelled), Apr; previous-month activity:
    assert set(rows) == {"2020-02-01", "2020-03-01"}
    assert rows["2020-02-01"].prev_active == 2 and rows["2020-02-01"].churners == 2
    assert rows["2020-03-01"].churn_rate_pct == 100.0


def test_discount_buckets_null_and_negative(spark, tiny):
    a = {r.discount_bucket: r.line_items for r in R.discount_buckets(tiny["items"]).collect()}
    assert a == {"0%": 2, "30%+": 1, "0-10%": 1}
    b = {r.discount_bucket: r.line_items for r in R.discount_buckets_amount(tiny["items"]).collect()}
    assert b["30%+"] == 1  # NULL unit price falls to the last bucket
    c = {r.discount_bucket: r.line_items
         for r in R.discount_buckets_list_price(tiny["items"], tiny["products"]).collect()}
    # NULL list price takes the ELSE 0 branch; a NULL unit price makes GREATEST NULL -> '30%+'
    assert c == {"10-20%": 1, "0%": 2, "30%+": 1}


def test_reorder_counts_missing_stock_as_zero(spark, tiny):
    inv = tiny["items"].sparkSession.createDataFrame([(0, 1, 3), (1, 1, 4), (0, 2, 30)],
                                                     "warehouse_id long, product_id long, quantity long")
    rows = {r.product_id: r for r in R.reorder_all_warehouses(tiny["products"], inv).collect()}
    assert rows[3].total_qty_across_warehouses == 0 and rows[3].units_to_order == 4
    assert rows[1].units_to_order == 3
    t = R.warehouse_transfers(tiny["products"], inv).collect()
    assert [(r.product_id, r.from_warehouse, r.to_warehouse, r.transfer_qty) for r in t] == []
    cost = R.restock_cost(tiny["products"], inv).first()
    assert cost.total_restock_cost == pytest.approx(3 * 2.0 + 4 * 1.0) and cost.products_below_level == 2


def test_no_sales_products_keeps_missing_category(spark, tiny):
    cats = tiny["items"].sparkSession.createDataFrame([("c1", "Cat one")], "category_id string, category_name string")
    rows = R.no_sales_products(tiny["products"], tiny["items"], cats).collect()
    assert [(r.product_id, r.category_name, r.times_ordered) for r in rows] == [(3, None, 0)]


def test_anti_joins_get_a_row_per_key(spark, tiny):
    """The joins sort one row per product or customer, however many items or orders there are."""
    cats = spark.createDataFrame([], "category_id string, category_name string")
    items = tiny["items"].select("product_id", "order_item_id").crossJoin(spark.range(50))
    orders = spark.createDataFrame([(1, i % 3, D(2020, 5, 1)) for i in range(60)], "order_id long, customer_id long, order_date date")
    customers = spark.createDataFrame([(i, "F", "L", "e", D(2020, 1, 1), "T") for i in range(5)], "customer_id long, first_name string, "
                                      "last_name string, email string, registration_date date, loyalty_tier string")
    unsold, idle = R.no_sales_products(tiny["products"], items, cats), R.no_orders_in_year(customers, orders, 2020)
    assert [r.product_id for r in unsold.collect()] == [3] and [r.customer_id for r in idle.collect()] == [3, 4]
    for out in (unsold, idle):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" in plan[plan.index("LeftAnti"):]


def test_percent_rank_ties_at_the_threshold(spark):
    # 11 customers in one tier: ranks 0.0 .. 1.0 by tenths; two tie at the 0.9 rank
    cust = spark.createDataFrame([(i, "F", str(i), "e", "T") for i in range(11)],
                                 "customer_id long, first_name string, last_name string, email string, loyalty_tier string")
    spend = [0, 0, 1, 2, 3, 4, 5, 6, 7, 9, 9]
    orders = spark.createDataFrame([(100 + i, i, D(2020, 5, 1), "Delivered", float(s)) for i, s in enumerate(spend) if s],
                                   "order_id long, customer_id long, order_date date, order_status string, total_amount double")
    out = R.tier_top_decile(cust, orders, days=90, as_of=D(2020, 5, 2)).collect()
    assert sorted(r.customer_id for r in out) == [9, 10]
    assert all(r.pr == pytest.approx(0.9) for r in out)


def test_q5_anti_join_equals_left_join_form(spark):
    m = RetailModel(spark, SF_ORACLE)
    anti = {r.product_id for r in R.no_sales_products(m.products, m.order_items, m.categories).collect()}
    lj = (m.products.join(m.order_items.select("product_id", "order_item_id"), "product_id", "left")
          .groupBy("product_id").agg(F.count("order_item_id").alias("n")).filter("n = 0"))
    assert anti == {r.product_id for r in lj.collect()}


def test_tier_upgrade_nearest_only(spark):
    m = RetailModel(spark, SF_ORACLE)
    all_tiers = R.tier_upgrade(m.customers, m.orders, m.loyalty_tiers, 90, 0.8, D(2001, 8, 2), limit=100000)
    nearest = R.tier_upgrade(m.customers, m.orders, m.loyalty_tiers, 90, 0.8, D(2001, 8, 2), limit=100000,
                             nearest_only=True)
    n_all, n_near = all_tiers.count(), nearest.count()
    assert n_near <= n_all
    assert nearest.groupBy("customer_id").count().filter("count > 1").count() == 0


def test_monthly_sales_gap_month_and_status_filter(spark, tiny):
    rows = {r.month: r for r in R.monthly_sales(tiny["orders"], D(2020, 1, 1), D(2020, 5, 1)).collect()}
    assert set(rows) == {"2020-01", "2020-02", "2020-03", "2020-04"}
    assert rows["2020-03"].cancelled_orders == 1 and rows["2020-03"].cancellation_rate == 100.0
    assert rows["2020-01"].total_orders == 2 and rows["2020-01"].revenue == 130.0
    pend = R.monthly_sales(tiny["orders"], D(2020, 1, 1), D(2020, 5, 1), ["Pending"]).collect()
    assert [(r.month, r.total_orders) for r in pend] == [("2020-01", 1)]  # months without rows vanish
    kpi = R.monthly_kpis(R.monthly_sales(tiny["orders"], D(2020, 1, 1), D(2020, 5, 1))).first()
    assert kpi.total_revenue == 270.0 and kpi.months == 4
