"""Retail star schema (products, customers, orders, order_items, ...) derived from the test tables.

The retail queries read a schema the test data does not have, so each retail table is a
view over the TPC-H-like tables.  Every view is written once, as SQL text with a few
dialect tokens, and rendered two ways: for Spark (``spark.sql`` with DataFrame arguments)
and for DuckDB (a ``WITH`` clause in front of an oracle query).  Both engines therefore
read identical retail tables.

The views only shape rows into the retail schema; the retail jobs themselves take any
tables of that schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table

# Dialect tokens: <<name>> is a table reference, <<idiv>> integer division,
# <<days(a, n)>> is written out per dialect below.
_DIALECT = {
    "spark": {"idiv": "div"},
    "duckdb": {"idiv": "//"},
}


def _r2(x: str) -> str:
    """Two-place rounding that both engines evaluate identically (half up on the double)."""
    return f"(floor(({x}) * 100 + 0.5) / 100)"


# Customers who never order and products that never sell are added under ids from here on, as
# every row of the test tables has orders and lines.
NEW_IDS = 1000000000

# view name -> (SQL template, base tables, retail views it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...], tuple[str, ...]]] = {
    "products": (
        "SELECT * FROM (" + "\nUNION ALL ".join(f"""SELECT {key} AS product_id,
       p_name AS product_name,
       p_partkey % (SELECT count(*) FROM <<supplier>>) AS supplier_id,
       p_type AS category_id,
       CAST((p_partkey * 7) % 100 AS INT) AS stock_quantity,
       p_size AS reorder_level,
       {_r2('p_retailprice * CAST(0.6 AS DOUBLE)')} AS cost_price,
       p_retailprice AS list_price
FROM <<part>> {where}""" for key, where in (("p_partkey", ""), (f"p_partkey + {NEW_IDS}", "WHERE p_partkey % 10 = 0"))) + ") p",
        ("part", "supplier"), ()),
    "categories": (
        """SELECT DISTINCT p_type AS category_id, p_type AS category_name FROM <<part>>""",
        ("part",), ()),
    "suppliers": (
        """SELECT s_suppkey AS supplier_id, s_name AS supplier_name FROM <<supplier>>""",
        ("supplier",), ()),
    "customers": (
        "SELECT * FROM (" + "\nUNION ALL ".join(f"""SELECT {key} AS customer_id,
       'Customer' AS first_name,
       substr(c_name, 10) AS last_name,
       concat(CAST({key} AS STRING), '@example.com') AS email,
       c_mktsegment AS loyalty_tier,
       <<regdate>> AS registration_date
FROM <<customer>> {where}""" for key, where in (("c_custkey", ""), (f"c_custkey + {NEW_IDS}", "WHERE c_custkey % 10 = 0"))) + ") c",
        ("customer",), ()),
    "orders": (
        """SELECT o_orderkey AS order_id,
       o_custkey AS customer_id,
       CAST(o_orderdate AS DATE) AS order_date,
       CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending'
            WHEN 'P' THEN 'Cancelled' END AS order_status,
       o_totalprice AS total_amount,
       o_orderkey % 5 AS warehouse_id
FROM <<orders>>""",
        ("orders",), ()),
    "order_items": (
        f"""SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),
                 CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)) AS order_item_id,
       l_orderkey AS order_id,
       l_partkey AS product_id,
       CAST(l_quantity AS INT) AS quantity,
       {_r2('l_extendedprice / l_quantity')} AS unit_price,
       l_extendedprice AS subtotal,
       CAST(floor(l_discount * 100 + 0.5) AS INT) AS discount_pct,
       {_r2(_r2('l_extendedprice / l_quantity') + ' * l_discount')} AS discount_amount,
       l_suppkey % 5 AS warehouse_id
FROM <<lineitem>>""",
        ("lineitem",), ()),
    # C3.2c reads unit prices set below the list price by the line's discount.
    "order_items_list": (
        f"""SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),
                 CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)) AS order_item_id,
       l_orderkey AS order_id,
       l_partkey AS product_id,
       CAST(l_quantity AS INT) AS quantity,
       {_r2('p_retailprice * (1 - l_discount)')} AS unit_price,
       l_extendedprice AS subtotal
FROM <<lineitem>> JOIN <<part>> ON p_partkey = l_partkey""",
        ("lineitem", "part"), ()),
    "warehouses": (
        """SELECT DISTINCT s_suppkey % 5 AS warehouse_id,
       concat('WH', CAST(s_suppkey % 5 AS STRING)) AS warehouse_name
FROM <<supplier>>""",
        ("supplier",), ()),
    "warehouse_inventory": (
        """SELECT l_suppkey % 5 AS warehouse_id,
       l_partkey AS product_id,
       CAST(sum(CAST(l_quantity AS BIGINT) % 10) AS BIGINT) AS quantity
FROM <<lineitem>>
GROUP BY l_suppkey % 5, l_partkey""",
        ("lineitem",), ()),
    "shipments": (
        """SELECT order_item_id, warehouse_id FROM <<order_items>>""",
        (), ("order_items",)),
    "employees": (
        """SELECT s_suppkey AS employee_id,
       'Employee' AS first_name,
       substr(s_name, 10) AS last_name,
       n_name AS department,
       CASE WHEN s_suppkey = 0 THEN NULL ELSE s_suppkey <<idiv>> 10 END AS manager_id
FROM <<supplier>> JOIN <<nation>> ON n_nationkey = s_nationkey""",
        ("supplier", "nation"), ()),
    # Fixed tier minimums (from the task's adapter definition), one tier per market segment
    # in alphabetical order: 0, 50000, 100000, 200000, 400000.
    "loyalty_tiers": (
        """SELECT tier_name,
       CAST(CASE rk WHEN 1 THEN 0 WHEN 2 THEN 50000 WHEN 3 THEN 100000
                    WHEN 4 THEN 200000 ELSE 400000 END AS DOUBLE) AS min_spend
FROM (SELECT tier_name, row_number() OVER (ORDER BY tier_name) AS rk
      FROM (SELECT DISTINCT c_mktsegment AS tier_name FROM <<customer>>) s) t""",
        ("customer",), ()),
    # ---- stand-in frames for the non-retail jobs (same two-dialect mechanism) ----
    # Social posts: one post per event; text timestamps, half of them with a zone suffix;
    # likes are click values (NULL otherwise), a view counts as a retweet.
    "posts": (
        """SELECT event_id AS tweet_id,
       concat(<<fmt_ts>>, CASE WHEN event_id % 2 = 0 THEN ' +0000' ELSE '' END) AS created_at,
       props AS text,
       CASE WHEN event_type = 'view' THEN event_id END AS retweeted_status_id,
       CASE WHEN event_type = 'click' THEN value END AS rating_numerator,
       CASE WHEN event_type = 'click' THEN 'doggo' ELSE 'None' END AS doggo,
       CASE WHEN event_type = 'view' THEN 'floofer' ELSE 'None' END AS floofer,
       CASE WHEN event_type = 'purchase' THEN 'pupper' ELSE 'None' END AS pupper,
       CASE WHEN event_type = 'signup' THEN 'puppo' ELSE 'None' END AS puppo,
       event_type AS name
FROM <<events>>""",
        ("events",), ()),
    # Daily series, one per event type: exact sum of the day's values.
    "series": (
        """SELECT event_type AS series_id, CAST(ts AS DATE) AS t,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM <<events>> GROUP BY event_type, CAST(ts AS DATE)""",
        ("events",), ()),
    # Documents with their (partial) labels: real NULLs for the unlabelled ones.
    "doc_frame": (
        """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
       CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS quality_tag
FROM <<documents>> d LEFT JOIN <<labels>> l ON l.doc_id = d.doc_id""",
        ("documents", "labels"), ()),
    # Yes/No answer text with stray blanks and mixed case, one per labelled document.
    "answers": (
        """SELECT doc_id, CASE WHEN quality = 1 THEN ' Yes' WHEN toxic = 1 THEN 'no'
                            ELSE 'NO ' END AS answer
FROM <<labels>>""",
        ("labels",), ()),
    # (truth, prediction) stand-ins: quality as truth, "not toxic" as the predicted class;
    # for many classes, the embedding's label and the index of its largest first-ten component.
    "binary_predictions": (
        """SELECT doc_id, quality AS y, CASE WHEN toxic = 1 THEN 0 ELSE 1 END AS p FROM <<labels>>""",
        ("labels",), ()),
    # Multiple-choice blocks built from parts; every 11th part lacks option C (invalid).
    "mcq_raw": (
        """SELECT p_partkey AS question_id,
       concat('Question: Which brand and type describe ', p_name, '?', <<nl>>,
              'A) ', p_brand, <<nl>>,
              'B) ', p_type, <<nl>>,
              CASE WHEN p_partkey % 11 = 0 THEN ''
                   ELSE concat('C) Size ', CAST(p_size AS STRING), <<nl>>) END,
              'd) Part ', CAST(p_partkey AS STRING), <<nl>>,
              'Correct answer: ', substr('ABCD', CAST(p_partkey % 4 AS INT) + 1, 1)) AS raw
FROM <<part>>""",
        ("part",), ()),
    # One quiz attempt per question: the user is the part's brand, the choice a letter.
    "attempts": (
        """SELECT p_brand AS user_id, p_partkey AS question_id,
       substr('ABCD', CAST((p_partkey * 7) % 4 AS INT) + 1, 1) AS choice
FROM <<part>>""",
        ("part",), ()),
    # Model generations: assistant turns echoed after 'Answer:' with repeated closing lines.
    "generations": (
        """SELECT conv_id, turn, concat('Answer: Fin.', <<nl>>, text, <<nl>>, 'FIN.') AS generation
FROM <<conversations>> WHERE role = 'assistant'""",
        ("conversations",), ()),
}


def _render(template: str, dialect: str) -> str:
    out = template
    out = out.replace("<<nl>>", "'\\n'" if dialect == "spark" else "chr(10)")
    if dialect == "spark":
        out = out.replace("<<fmt_ts>>", "date_format(ts, 'yyyy-MM-dd HH:mm:ss')")
    else:
        out = out.replace("<<fmt_ts>>", "strftime(ts, '%Y-%m-%d %H:%M:%S')")
    if dialect == "spark":
        out = out.replace("<<regdate>>",
                          "date_add(DATE'1995-01-01', CAST((c_custkey * 37) % 2000 AS INT))")
    else:
        out = out.replace("<<regdate>>",
                          "(DATE '1995-01-01' + CAST((c_custkey * 37) % 2000 AS INTEGER))")
    for k, v in _DIALECT[dialect].items():
        out = out.replace(f"<<{k}>>", v)
    # Remaining tokens are table references.
    import re

    if dialect == "spark":
        return re.sub(r"<<(\w+)>>", r"{\1}", out)
    return re.sub(r"<<(\w+)>>", r"\1", out)


def _closure(names) -> list[str]:
    """Views in dependency order, including the views they read."""
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for dep in VIEWS[n][2]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def duckdb_with(names, body: str) -> str:
    """Oracle SQL: the named retail views as CTEs in front of ``body``."""
    parts = [f"{n} AS (\n{_render(VIEWS[n][0], 'duckdb')}\n)" for n in _closure(names)]
    return "WITH " + ",\n".join(parts) + "\n" + body


class RetailModel:
    """Retail views over one test-data folder, built lazily as Spark DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._views: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in VIEWS:
            raise AttributeError(name)
        return self.view(name)

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            template, base, deps = VIEWS[name]
            args = {t: read_table(self.spark, self.sf_dir, t) for t in base}
            for d in deps:
                args[d] = self.view(d)
            self._views[name] = self.spark.sql(_render(template, "spark"), **args)
        return self._views[name]
