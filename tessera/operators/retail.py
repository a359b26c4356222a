"""Named retail analytics over a star schema (products, customers, orders, order_items, ...).

Each function takes the retail tables as DataFrames and returns the report as a
DataFrame.  Plans are written so the work scales:

* aggregates that feed a join are computed first (one row per key) and joined after;
* "has no rows in" tests are anti joins, not outer join + count;
* scalar aggregates (one row) are the only explicitly broadcast sides;
* every other join strategy is left to Catalyst / AQE, which broadcasts a side only after
  measuring it and splits skewed partitions;
* money is summed as whole cents (exact LONG sums), so results do not depend on the row
  order or the partitioning.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import (cents, exact_avg, from_cents, full_name, money_sum, month_start,
                                null_strict_greatest, pct, round_half_up)
from .ranking import with_percent_rank

# Fixed values of the reports (status name and discount bucket labels, in order).
CANCELLED = "Cancelled"
BUCKET_LABELS = ("0%", "0-10%", "10-20%", "20-30%", "30%+")


def _d(x) -> F.Column:
    if isinstance(x, str):
        x = _dt.date.fromisoformat(x)
    return F.lit(x)


def low_stock(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Q1: products whose stock is under the reorder level, with their supplier."""
    p = products.filter(F.col("stock_quantity") < F.col("reorder_level"))
    return (p.join(suppliers, "supplier_id")
            .select("product_name", "stock_quantity", "reorder_level", "supplier_name",
                    (F.col("reorder_level") - F.col("stock_quantity")).alias("units_to_order"))
            .orderBy(F.desc("units_to_order")))


def inactive_customers(customers: DataFrame, orders: DataFrame, cutoff, as_of) -> DataFrame:
    """Q2: customers whose last order is before ``cutoff`` or who never ordered."""
    last = orders.groupBy("customer_id").agg(F.max("order_date").alias("last_order_date"))
    out = (customers.join(last, "customer_id", "left")
           .filter((F.col("last_order_date") < _d(cutoff)) | F.col("last_order_date").isNull())
           .select("customer_id", "first_name", "last_name", "email", "loyalty_tier",
                   "last_order_date",
                   F.datediff(_d(as_of), F.col("last_order_date")).alias("days_since_order")))
    return out.orderBy(F.desc_nulls_last("days_since_order"))


def inactive_customers_anti(customers: DataFrame, orders: DataFrame, cutoff) -> DataFrame:
    """C4.3: the same customer set as Q2, as an anti join against recent orders."""
    recent = orders.filter(F.col("order_date") >= _d(cutoff)).select("customer_id").distinct()
    return (customers.join(recent, "customer_id", "left_anti")
            .select("customer_id", "first_name", "last_name", "email", "loyalty_tier")
            .orderBy("customer_id"))


def order_details(orders: DataFrame, customers: DataFrame, order_items: DataFrame,
                  products: DataFrame, start_dt) -> DataFrame:
    """Q3: order x item x product x customer lines since ``start_dt`` (all statuses)."""
    o = orders.filter(F.col("order_date") >= _d(start_dt))
    return (o.join(customers, "customer_id")
            .join(order_items, "order_id")
            .join(products, "product_id")
            .select("order_id",
                    full_name("first_name", "last_name").alias("customer_name"),
                    "email", "order_date", "product_name",
                    "quantity", "unit_price", "subtotal", "order_status")
            .orderBy(F.desc("order_date"), "order_id"))


def category_revenue(categories: DataFrame, products: DataFrame, order_items: DataFrame,
                     orders: DataFrame) -> DataFrame:
    """Q4: per category orders, units, revenue, mean unit price and profit (no Cancelled).

    Two explicit phases: lines are first reduced to one row per (category, order) with
    partial sums (this is also the distinct-order count), then per category; the category
    names are joined to the few aggregated rows.
    """
    live = orders.filter(F.col("order_status") != CANCELLED).select("order_id")
    lines = (order_items.join(live, "order_id")
             .join(products.select("product_id", "category_id", "cost_price"), "product_id"))
    per_order = lines.groupBy("category_id", "order_id").agg(
        F.sum("quantity").alias("_q"), F.sum(cents("subtotal")).alias("_rev"),
        F.sum(cents("unit_price")).alias("_price"), F.count("unit_price").alias("_n_price"),
        F.sum(cents("subtotal") - cents("cost_price") * F.col("quantity")).alias("_profit"))
    per_cat = per_order.groupBy("category_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("_q").cast("long").alias("units_sold"),
        from_cents(F.sum("_rev")).alias("total_revenue"),
        (from_cents(F.sum("_price")) / F.sum("_n_price")).alias("avg_selling_price"),
        from_cents(F.sum("_profit")).alias("profit"))
    return (per_cat.join(categories, "category_id")
            .select("category_name", "total_orders", "units_sold", "total_revenue",
                    "avg_selling_price", "profit")
            .orderBy(F.desc("total_revenue")))


def no_sales_products(products: DataFrame, order_items: DataFrame,
                      categories: DataFrame) -> DataFrame:
    """Q5: products without any order item, with their category (which may be missing).

    Items are first reduced to one row per product in the scanning tasks, so that the anti join
    moves and sorts products, not items."""
    sold = order_items.filter(F.col("order_item_id").isNotNull()).select("product_id").distinct()
    unsold = products.join(sold, "product_id", "left_anti")
    return (unsold.join(categories, "category_id", "left")
            .select("product_id", "product_name", "stock_quantity", "category_name",
                    F.lit(0).cast("long").alias("times_ordered"))
            .orderBy(F.desc("stock_quantity")))


def no_orders_in_year(customers: DataFrame, orders: DataFrame, year: int) -> DataFrame:
    """Q6: customers without an order in ``year`` (half-open date range, pushed to the scan)."""
    start, end = _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1)
    in_year = orders.filter((F.col("order_date") >= F.lit(start)) & (F.col("order_date") < F.lit(end))
                            & F.col("order_id").isNotNull()).select("customer_id").distinct()
    return (customers.join(in_year, "customer_id", "left_anti")
            .select("customer_id", "first_name", "last_name", "email", "registration_date",
                    "loyalty_tier", F.lit(0).cast("long").alias("order_count_year"))
            .orderBy("customer_id"))


def employee_hierarchy(employees: DataFrame) -> DataFrame:
    """Q7: each employee with the manager's name and department (roots keep NULLs)."""
    e1 = employees.alias("e1")
    e2 = employees.alias("e2")
    return (e1.join(e2, F.col("e1.manager_id") == F.col("e2.employee_id"), "left")
            .orderBy(F.col("e2.employee_id").asc_nulls_first(), F.col("e1.employee_id"))
            .select(F.col("e1.employee_id").alias("employee_id"),
                    full_name("e1.first_name", "e1.last_name").alias("employee_name"),
                    F.col("e1.department").alias("department"),
                    full_name("e2.first_name", "e2.last_name").alias("manager_name"),
                    F.col("e2.department").alias("manager_department")))


def _orders_per_customer(orders: DataFrame) -> DataFrame:
    """One pass over orders: per customer the order count, spend (cents) and the count of
    amounts (for the global mean order value)."""
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("_n"), F.sum(cents("total_amount")).alias("_spent"),
        F.count("total_amount").alias("_n_amt"))


def customer_totals(customers: DataFrame, orders: DataFrame, per=None) -> DataFrame:
    """Orders and spend per customer, zero for customers without orders."""
    per = per if per is not None else _orders_per_customer(orders)
    return customers.join(per.select("customer_id", "_n", "_spent"), "customer_id", "left").select(
        "customer_id", full_name("first_name", "last_name").alias("customer_name"),
        "loyalty_tier",
        F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("total_orders"),
        F.coalesce(F.col("_spent"), F.lit(0).cast("long")).alias("_spent_c"))


def top_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Q11: customers spending more than the mean customer (zero spenders in the mean).

    Orders are read once: the per-customer aggregate (one row per customer, checkpointed
    because three parts of the report read it) also gives the mean order value (total of all
    amounts over their count), so no second pass over orders is needed.
    """
    from ..session import ensure_checkpoint_dir

    per = _orders_per_customer(orders)
    ensure_checkpoint_dir(orders.sparkSession)
    per = per.checkpoint(eager=True)
    ct = customer_totals(customers, orders, per)
    mean_spend = ct.agg((from_cents(F.sum("_spent_c")) / F.count(F.lit(1)))
                        .alias("_avg_total_spent"))
    aov = per.agg((from_cents(F.sum("_spent")) / F.sum("_n_amt")).alias("avg_order_value"))
    # Both sides are single-row global aggregates: broadcasting them is size-safe.
    j = ct.crossJoin(F.broadcast(mean_spend)).crossJoin(F.broadcast(aov))
    spent = from_cents("_spent_c")
    return (j.filter(spent > F.col("_avg_total_spent"))
            .select("customer_id", "customer_name", "loyalty_tier", "total_orders",
                    spent.alias("total_spent"), "avg_order_value",
                    (spent - F.col("avg_order_value") * F.col("total_orders")).alias("vs_average"))
            .orderBy(F.desc("total_spent")))


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Non-cancelled orders per day: count and exact revenue (``_rev``, cents)."""
    return (orders.filter(F.col("order_status") != CANCELLED)
            .groupBy(F.to_date("order_date").alias("order_day"))
            .agg(F.count("order_id").alias("orders_count"),
                 F.sum(cents("total_amount")).alias("_rev")))


def daily_running(orders: DataFrame) -> DataFrame:
    """Q14: daily count and revenue, running total and 3-row moving mean.

    The window has no partition key, so it runs after the daily aggregation: its input is
    one row per day whatever the size of ``orders``.
    """
    from pyspark.sql import Window

    d = daily_revenue(orders)
    w_run = Window.orderBy("order_day").rowsBetween(Window.unboundedPreceding, 0)
    w3 = Window.orderBy("order_day").rowsBetween(-2, 0)
    return (d.select(
        "order_day", "orders_count", from_cents("_rev").alias("daily_revenue"),
        from_cents(F.sum("_rev").over(w_run)).alias("running_total"),
        (from_cents(F.sum("_rev").over(w3)) / F.count("_rev").over(w3)).alias("moving_avg_3day"))
        .orderBy("order_day"))


def monthly_sales(orders: DataFrame, start_dt, end_dt, statuses=None) -> DataFrame:
    """Q18: per month orders, customers, revenue (Cancelled included), AOV and cancellations."""
    o = orders.filter((F.col("order_date") >= _d(start_dt)) & (F.col("order_date") < _d(end_dt)))
    if statuses:
        o = o.filter(F.col("order_status").isin(list(statuses)))
    cancelled = F.when(F.col("order_status") == CANCELLED, 1).otherwise(0)
    return (o.groupBy(F.date_format("order_date", "yyyy-MM").alias("month"))
            .agg(F.count_distinct("order_id").alias("total_orders"),
                 F.count_distinct("customer_id").alias("unique_customers"),
                 money_sum("total_amount").alias("revenue"),
                 exact_avg("total_amount").alias("avg_order_value"),
                 F.sum(cancelled).cast("long").alias("cancelled_orders"),
                 round_half_up(pct(F.sum(cancelled), F.count(F.lit(1)))).alias("cancellation_rate"))
            .orderBy(F.desc("month")))


def monthly_kpis(monthly: DataFrame) -> DataFrame:
    """Period KPIs from the monthly rows; AOV is the unweighted mean of the months."""
    return monthly.agg(
        money_sum("revenue").alias("total_revenue"),
        F.sum("total_orders").cast("long").alias("total_orders"),
        F.sum("unique_customers").cast("long").alias("unique_customers_sum"),
        F.avg("avg_order_value").alias("avg_order_value_mean"),
        F.count(F.lit(1)).alias("months"))


def _stock_totals(warehouse_inventory: DataFrame) -> DataFrame:
    return warehouse_inventory.groupBy("product_id").agg(F.sum("quantity").alias("_total_qty"))


def reorder_all_warehouses(products: DataFrame, warehouse_inventory: DataFrame) -> DataFrame:
    """C1.1: products whose stock summed over warehouses is under the reorder level."""
    total = F.coalesce(F.col("_total_qty"), F.lit(0)).cast("long")
    return (products.join(_stock_totals(warehouse_inventory), "product_id", "left")
            .filter(total < F.col("reorder_level"))
            .select("product_id", "product_name",
                    total.alias("total_qty_across_warehouses"), "reorder_level",
                    F.greatest(F.col("reorder_level") - total, F.lit(0)).cast("long")
                    .alias("units_to_order"))
            .orderBy(F.desc("units_to_order"), "product_name"))


def restock_cost(products: DataFrame, warehouse_inventory: DataFrame) -> DataFrame:
    """C1.2: one row, cost of lifting every product to its reorder level (all warehouses)."""
    total = F.coalesce(F.col("_total_qty"), F.lit(0)).cast("long")
    deficits = (products.join(_stock_totals(warehouse_inventory), "product_id", "left")
                .filter(total < F.col("reorder_level"))
                .select(F.greatest(F.col("reorder_level") - total, F.lit(0)).alias("deficit_units"),
                        "cost_price"))
    return deficits.agg(
        from_cents(F.sum(F.col("deficit_units").cast("long") * cents("cost_price")))
        .alias("total_restock_cost"),
        F.count(F.lit(1)).alias("products_below_level"))


def restock_cost_single_site(products: DataFrame) -> DataFrame:
    """C1.2 variant when stock is one column of ``products``."""
    p = products.filter(F.col("stock_quantity") < F.col("reorder_level"))
    deficit = (F.col("reorder_level") - F.col("stock_quantity")).cast("long")
    return p.agg(from_cents(F.sum(deficit * cents("cost_price"))).alias("total_restock_cost"),
                 F.count(F.lit(1)).alias("products_below_level"))


def warehouse_transfers(products: DataFrame, warehouse_inventory: DataFrame) -> DataFrame:
    """C1.3: per product, every surplus warehouse paired with every deficit warehouse.

    As in the source report each warehouse is compared with the product's reorder level
    and every surplus x deficit pair is listed, so one surplus can be offered twice.
    Pairs only form inside one product, over its warehouses.
    """
    per_site = warehouse_inventory.groupBy("warehouse_id", "product_id").agg(
        F.sum("quantity").alias("qty"))
    diffs = per_site.join(products.select("product_id", "reorder_level", "product_name"),
                          "product_id").select(
        "warehouse_id", "product_id", "product_name",
        (F.col("qty") - F.col("reorder_level")).alias("delta"))
    s = diffs.filter(F.col("delta") > 0).select(
        "product_id", "product_name", F.col("warehouse_id").alias("from_warehouse"),
        F.col("delta").alias("surplus_qty"))
    d = diffs.filter(F.col("delta") < 0).select(
        "product_id", F.col("warehouse_id").alias("to_warehouse"), F.col("delta").alias("deficit_qty"))
    qty = F.least(F.col("surplus_qty"), -F.col("deficit_qty"))
    return (s.join(d, "product_id")
            .filter(qty > 0)
            .select("product_id", "product_name", "from_warehouse", "to_warehouse",
                    qty.cast("long").alias("transfer_qty"))
            .orderBy("product_id", F.desc("transfer_qty")))


def _active_months(orders: DataFrame) -> DataFrame:
    """Distinct (month, customer) with a non-cancelled order."""
    return (orders.filter(F.col("order_status") != CANCELLED)
            .select(month_start("order_date").alias("m"), "customer_id").distinct())


def cohort_retention(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """C2.1: registration-month cohorts x months since registration: size, active, %.

    A cohort without any later activity keeps one row with NULL index and counts.
    """
    cust = customers.select("customer_id", month_start("registration_date").alias("cohort_m"))
    act = _active_months(orders)
    ca = (cust.join(act, "customer_id")
          .withColumn("cohort_index", F.timestamp_diff("MONTH", F.col("cohort_m"), F.col("m")))
          .filter(F.col("cohort_index") >= 0))
    sizes = cust.groupBy("cohort_m").agg(F.count_distinct("customer_id").alias("cohort_size"))
    # (cohort, index, customer) is unique because act is distinct per (month, customer)
    # and a customer has one cohort, so a plain count is the distinct count.
    counts = ca.groupBy("cohort_m", "cohort_index").agg(
        F.count(F.lit(1)).alias("active_customers"))
    return (sizes.join(counts, "cohort_m", "left")
            .select(F.date_format("cohort_m", "yyyy-MM-01").alias("cohort_month"),
                    F.col("cohort_index").cast("long").alias("cohort_index"),
                    "cohort_size", F.col("active_customers").cast("long").alias("active_customers"),
                    round_half_up(pct("active_customers", "cohort_size")).alias("retention_pct"))
            .orderBy("cohort_month", F.asc_nulls_first("cohort_index")))


def cohort_grid(retention: DataFrame, first: int = 0) -> DataFrame:
    """H3: cohort x month-index grid of retention % (heat-map input): per cohort an array whose
    place i holds the cell of index ``first`` + i, NULL where nobody bought, up to the largest
    index of any cohort.  A cohort has at most one cell a calendar month."""
    r = retention.filter(F.col("cohort_index").isNotNull())
    cells = r.groupBy("cohort_month").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("cohort_index").cast("int"), "retention_pct"))).alias("_cell"))
    last = F.broadcast(r.agg(F.max(F.col("cohort_index").cast("int")).alias("_last")))  # one row
    index = F.sequence(F.lit(first), F.col("_last"))
    return cells.crossJoin(last).select(
        "cohort_month", F.transform(index, lambda i: F.try_element_at("_cell", i)).alias("cells"))


def monthly_churn(orders: DataFrame) -> DataFrame:
    """C2.2: churn = active last month and not this month, over active last month.

    The month list comes from all orders; activity ignores Cancelled; a month whose
    previous month had no activity has no row.  From the distinct (month, customer)
    activity, each customer's next active month (``lead`` over the customer's months: at
    most one row per calendar month, so bounded even for a very active customer) says
    whether the customer is still active in the following month.
    """
    from pyspark.sql import Window

    months = orders.select(month_start("order_date").alias("curr_m")).distinct()
    active = _active_months(orders)
    nxt = F.lead("m").over(Window.partitionBy("customer_id").orderBy("m"))
    follow = active.select(F.add_months("m", 1).alias("curr_m"),
                           (F.coalesce(nxt, F.lit(None).cast("date")) == F.add_months("m", 1))
                           .alias("_stays"))
    per_month = follow.groupBy("curr_m").agg(
        F.count(F.lit(1)).alias("prev_active"),
        F.sum(F.when(F.col("_stays"), 0).otherwise(1)).cast("long").alias("churners"))
    return (per_month.join(months, "curr_m")
            .select(F.date_format("curr_m", "yyyy-MM-01").alias("month"), "prev_active", "churners",
                    F.when(F.col("prev_active") > 0, round_half_up(pct("churners", "prev_active")))
                    .alias("churn_rate_pct"))
            .orderBy("month"))


def trailing_spend(orders: DataFrame, days: int, as_of) -> DataFrame:
    """Non-cancelled spend per customer over the ``days`` days up to ``as_of`` (cents)."""
    since = F.date_sub(_d(as_of), days)
    return (orders.filter((F.col("order_status") != CANCELLED) & (F.col("order_date") >= since))
            .groupBy("customer_id").agg(F.sum(cents("total_amount")).alias("_spend")))


def tier_upgrade(customers: DataFrame, orders: DataFrame, loyalty_tiers: DataFrame,
                 days: int = 90, threshold: float = 0.8, as_of=None, limit: int = 200,
                 nearest_only: bool = False) -> DataFrame:
    """C2.3a: customers whose trailing spend reaches ``threshold`` x a higher tier's minimum.

    By default every higher tier is a candidate (as in the source report);
    ``nearest_only=True`` keeps only the next tier up.
    """
    as_of = as_of or _dt.date.today()
    t1 = loyalty_tiers.select(F.col("tier_name").alias("current_tier"),
                              F.col("min_spend").alias("current_min"))
    t2 = loyalty_tiers.select(F.col("tier_name").alias("next_tier"),
                              F.col("min_spend").alias("next_min"))
    # Theta join over the tier dimension only (tiers x tiers), never over customers.
    nt = t1.join(t2, F.col("next_min") > F.col("current_min"))
    if nearest_only:
        lowest = nt.groupBy("current_tier").agg(F.min("next_min").alias("_m"))
        nt = nt.join(lowest, "current_tier").filter(F.col("next_min") == F.col("_m")).drop("_m")
    sw = trailing_spend(orders, days, as_of)
    spend = from_cents("_spend")
    c = customers.select("customer_id", full_name("first_name", "last_name").alias("customer_name"),
                         F.col("loyalty_tier").alias("current_tier"))
    out = (c.join(sw, "customer_id")
           .join(nt.select("current_tier", "next_tier", "next_min"), "current_tier")
           .filter(spend >= F.lit(float(threshold)) * F.col("next_min"))
           .select("customer_id", "customer_name", "current_tier", "next_tier",
                   spend.alias("spend_lookback"), "next_min",
                   round_half_up(pct(spend, "next_min")).alias("pct_to_next")))
    return out.orderBy(F.desc("pct_to_next"), F.desc("spend_lookback"), "customer_id",
                       "next_tier").limit(limit)


def tier_top_decile(customers: DataFrame, orders: DataFrame, days: int = 90, as_of=None,
                    limit: int = 200, min_rank: float = 0.90) -> DataFrame:
    """C2.3b: top 10% of trailing spenders inside each tier (zero spenders ranked too).

    PERCENT_RANK is computed by ``ranking.with_percent_rank``: ties are collapsed and each
    tier is split into value ranges, so a tier holding most customers is not one task.
    """
    as_of = as_of or _dt.date.today()
    sw = trailing_spend(orders, days, as_of)
    ranked = (customers.join(sw, "customer_id", "left")
              .select("customer_id", full_name("first_name", "last_name").alias("customer_name"),
                      "loyalty_tier",
                      from_cents(F.coalesce(F.col("_spend"), F.lit(0).cast("long")))
                      .alias("spend_lookback")))
    ranked = with_percent_rank(ranked, ["loyalty_tier"], "spend_lookback", out_col="pr")
    return (ranked.filter(F.col("pr") >= F.lit(min_rank))
            .orderBy("loyalty_tier", F.desc("spend_lookback"), "customer_id")
            .limit(limit))


PAIR_BLOCK = 256


def product_pairs(order_items: DataFrame, products: DataFrame, min_orders: int = 5,
                  limit: int = 100) -> DataFrame:
    """C3.1: product pairs bought in the same order at least ``min_orders`` times.

    Lines are first reduced to one row per (order, product) with its profit.  A pair can
    reach ``min_orders`` only if each product occurs in that many orders, so products below
    the bound are dropped before the self join (exact pruning).  Pairs inside an order are
    made in tiles of ``PAIR_BLOCK`` x ``PAIR_BLOCK`` products, so a very large order is spread
    over tasks; the pair aggregation is combined map-side before its shuffle.
    """
    from ..session import ensure_checkpoint_dir

    ip = (order_items.join(products.select("product_id", "cost_price"), "product_id")
          .groupBy("order_id", "product_id")
          .agg(F.sum((cents("unit_price") - cents("cost_price")) * F.col("quantity"))
               .alias("profit")))  # cents
    ensure_checkpoint_dir(order_items.sparkSession)
    ip = ip.checkpoint(eager=True)  # read three times below
    frequent = (ip.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") >= min_orders).select("product_id"))
    ip = ip.join(frequent, "product_id", "left_semi")
    # Orders of many products are cut into blocks; each two blocks meet in a tile of their own.
    size = ip.groupBy("order_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(PAIR_BLOCK)).cast("int").alias("_blocks"))
    ip = ip.join(size, "order_id").withColumn("_block", F.pmod(F.xxhash64("product_id"), F.col("_blocks")).cast("int"))
    # The product of the smaller id is the left one: it meets the blocks of all right ones.
    tile = ["order_id", "_left", "_right"]
    every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    a = ip.withColumn("_right", every).select("order_id", F.col("_block").alias("_left"), "_right",
                                              F.col("product_id").alias("prod_a"), F.col("profit").alias("pa"))
    b = ip.withColumn("_left", every).select("order_id", "_left", F.col("_block").alias("_right"),
                                             F.col("product_id").alias("prod_b"), F.col("profit").alias("pb"))
    pairs = a.join(b, tile).filter(F.col("prod_a") < F.col("prod_b"))
    return (pairs.groupBy("prod_a", "prod_b")
            .agg(F.count(F.lit(1)).alias("orders_together"),
                 from_cents(F.sum(F.col("pa") + F.col("pb"))).alias("total_pair_profit"))
            .filter(F.col("orders_together") >= min_orders)
            .orderBy(F.desc("total_pair_profit"), F.desc("orders_together"), "prod_a", "prod_b")
            .limit(limit))


def _bucket(disc) -> F.Column:
    """0 -> first label; upper limits 10, 20, 30 (inclusive) -> next labels; else the last."""
    zero, b10, b20, b30, top = BUCKET_LABELS
    return (F.when(disc == 0, zero).when(disc <= 10, b10).when(disc <= 20, b20)
            .when(disc <= 30, b30).otherwise(top))


def _bucket_rank(b) -> F.Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in BUCKET_LABELS]), b) - 1, F.lit(4))


def _bucket_report(df: DataFrame, cents_col: str) -> DataFrame:
    """Per bucket: lines, exact revenue and mean line value from a revenue-in-cents column."""
    rev = from_cents(F.sum(cents_col))
    return (df.groupBy("discount_bucket")
            .agg(F.count(F.lit(1)).alias("line_items"), rev.alias("revenue"),
                 round_half_up(rev / F.count(cents_col)).alias("avg_line_value"))
            .orderBy(_bucket_rank(F.col("discount_bucket"))))


def discount_buckets(order_items: DataFrame) -> DataFrame:
    """C3.2a: lines by discount_pct bucket (NULL and negative count as 0)."""
    p = F.col("discount_pct")
    disc = F.when(p.isNull(), 0).when(p < 0, 0).otherwise(p)
    return _bucket_report(order_items.select(_bucket(disc).alias("discount_bucket"),
                                             cents("subtotal").alias("_rev_c")), "_rev_c")


def discount_buckets_amount(order_items: DataFrame) -> DataFrame:
    """C3.2b: % = 100 x amount / (price + amount), 0 when price <= 0; revenue = price x qty."""
    price, amt = F.col("unit_price"), F.col("discount_amount")
    disc = F.when(price <= 0, F.lit(0.0)).otherwise(pct(amt, price + amt))
    rev = cents("unit_price") * F.col("quantity")
    return _bucket_report(order_items.select(_bucket(disc).alias("discount_bucket"),
                                             rev.alias("_rev_c")), "_rev_c")


def discount_buckets_list_price(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """C3.2c: % below the product's list price, floored at 0 (NULL price -> '30%+')."""
    j = order_items.join(products.select("product_id", "list_price"), "product_id")
    lp, up = F.col("list_price"), F.col("unit_price")
    disc = F.when(lp > 0, null_strict_greatest(F.lit(0.0), pct(lp - up, lp))).otherwise(F.lit(0.0))
    rev = cents("unit_price") * F.col("quantity")
    return _bucket_report(j.select(_bucket(disc).alias("discount_bucket"),
                                   rev.alias("_rev_c")), "_rev_c")


def _named_revenue(per_warehouse: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Names joined to one revenue row per warehouse."""
    return (per_warehouse.join(warehouses, "warehouse_id")
            .select("warehouse_id", "warehouse_name", "revenue").orderBy(F.desc("revenue")))


def warehouse_revenue_item(order_items: DataFrame, orders: DataFrame,
                           warehouses: DataFrame) -> DataFrame:
    """C3.3a: revenue per warehouse through order_items.warehouse_id (no Cancelled)."""
    live = orders.filter(F.col("order_status") != CANCELLED).select("order_id")
    return _named_revenue(order_items.join(live, "order_id").groupBy("warehouse_id")
                          .agg(money_sum("subtotal").alias("revenue")), warehouses)


def warehouse_revenue_order(orders: DataFrame, warehouses: DataFrame) -> DataFrame:
    """C3.3b: revenue per warehouse through orders.warehouse_id, from total_amount."""
    return _named_revenue(orders.filter(F.col("order_status") != CANCELLED).groupBy("warehouse_id")
                          .agg(money_sum("total_amount").alias("revenue")), warehouses)


def warehouse_revenue_shipment(shipments: DataFrame, order_items: DataFrame, orders: DataFrame,
                               warehouses: DataFrame) -> DataFrame:
    """C3.3c: revenue per warehouse through the shipments mapping of items."""
    live = orders.filter(F.col("order_status") != CANCELLED).select("order_id")
    items = order_items.select("order_item_id", "order_id", "subtotal")
    sold = shipments.select("order_item_id", "warehouse_id").join(items, "order_item_id").join(live, "order_id")
    return _named_revenue(sold.groupBy("warehouse_id").agg(money_sum("subtotal").alias("revenue")), warehouses)
