"""Trust work on the large input tables (grows with the scale factor).

* customers: four trust dimensions from the customer row and its orders
  (orders are pre-aggregated per customer before the join, so a customer
  with a third of all orders is one partial-aggregate row, not a hot group)
* nations: two independent estimates per indicator (orders vs line items)
* documents: label coverage and cleanliness per (lang, source)
* contracts: declared rules over orders, line items, customers, events,
  documents and labels, evaluated to pass / warn / fail
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgrid.operators.quality import (
    KeyUse, Rule, compile_contracts, compile_rules, count_where, duplicate_keys, evaluate_compiled, evaluate_contracts,
    key_counts, owned_again, rows_owned, share_where, used_without_owner,
)
from trustgrid.operators.score import VERDICT_COLUMNS, Dimension, round_half_up, with_verdict
from trustgrid.sources.tables import read_table

RECENT_SINCE = "2000-01-01 00:00:00"  # compared as TIMESTAMP_NTZ: no session time-zone shift
THIN_HISTORY_ORDERS = 5

# Customer trust dimensions (name, weight) in ordinal order.
CUSTOMER_DIMENSIONS = (
    ("account_standing", 1.0),
    ("activity", 1.0),
    ("recency", 2.0),
    ("priority_specified", 0.5),
)


def order_activity(orders: DataFrame) -> DataFrame:
    """Per-customer order counts (one partial aggregation)."""
    return orders.groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"),
        F.count_if(F.col("o_orderdate") >= F.lit(RECENT_SINCE).cast("timestamp_ntz")).alias("n_recent"),
        F.count_if(F.col("o_orderpriority") != "4-NOT SPECIFIED").alias("n_specified"),
    )


def customer_dimension_frame(spark: SparkSession, sf_dir: str, clamp: bool = True) -> DataFrame:
    """Customer LEFT JOIN its order activity, with raw dimension scores."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    act = order_activity(read_table(spark, sf_dir, "orders"))
    j = cust.join(act, cust["c_custkey"] == act["o_custkey"], "left")
    n = F.col("n_orders")
    activity = n / 20.0
    return j.select(
        "c_custkey", "c_nationkey",
        (F.coalesce(n, F.lit(0)) + 1).alias("population"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("c_acctbal") + 1000.0) / 11000.0)).alias("s0"),
        (F.least(F.lit(1.0), activity) if clamp else activity).alias("s1"),
        (F.col("n_recent") / n).alias("s2"),
        (F.col("n_specified") / n).alias("s3"),
        F.coalesce(n < THIN_HISTORY_ORDERS, F.lit(True)).alias("thin"),
    )


def _dims(df: DataFrame) -> list[Dimension]:
    thin = F.col("thin")
    lows = [F.lit(False), F.col("s1").isNull(), thin, thin]
    return [Dimension(name, F.col(f"s{i}"), w, lows[i], weak_signal=(name == "priority_specified"))
            for i, (name, w) in enumerate(CUSTOMER_DIMENSIONS)]


def customer_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-row verdict over the wide dimension columns: no extra shuffle."""
    df = customer_dimension_frame(spark, sf_dir)
    return with_verdict(df, _dims(df), cache_key="customer").select(
        "c_custkey", "c_nationkey",
        *[round_half_up(F.col(f"s{i}"), 4).alias(f"{n}_score") for i, (n, _) in enumerate(CUSTOMER_DIMENSIONS)],
        *VERDICT_COLUMNS)


def customer_dimensions_long(spark: SparkSession, sf_dir: str, clamp: bool = True,
                             fill_missing: bool = True) -> DataFrame:
    """One row per (customer, dimension): the long form the generic verdict,
    fix ranking and re-scoring consume. Missing scores become 0 with
    ``is_missing`` and low confidence (unless ``fill_missing`` is off)."""
    df = customer_dimension_frame(spark, sf_dir, clamp=clamp)
    dims = _dims(df)
    cells = F.array(*[
        F.struct(F.lit(d.name).alias("dimension"), F.lit(i).alias("ordinal"),
                 (F.coalesce(d.score, F.lit(0.0)) if fill_missing else d.score).alias("score"),
                 F.lit(d.weight).alias("weight"),
                 (F.coalesce(d.low_confidence, F.lit(False)) | d.score.isNull()).alias("low_confidence"),
                 d.score.isNull().alias("is_missing"),
                 F.lit(d.weak_signal).alias("weak_signal"))
        for i, d in enumerate(dims)
    ])
    return df.select("c_custkey", "population", F.inline(cells))


# --- nations: corroboration ------------------------------------------------------

def nation_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation: order-level and line-level shares (percent) for three indicators.

    Line items are reduced to one row per order first; that aggregate is
    already partitioned by order key, so joining orders to it moves only
    the orders side.
    """
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("l_linestatus") == "F").alias("n_lf"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_lr"),
        F.count_if(F.col("l_discount") >= 0.05).alias("n_ld"),
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Orders -> per-customer partial counts BEFORE meeting the customer table:
    # a customer holding a third of all orders becomes one row, so the
    # customer join is 1:1 and cannot skew.
    per_cust = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_of"),
        F.count_if(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("n_ou"),
        F.count_if(F.col("o_orderpriority") != "4-NOT SPECIFIED").alias("n_os"),
        F.sum("n_lines").alias("n_lines"), F.sum("n_lf").alias("n_lf"),
        F.sum("n_lr").alias("n_lr"), F.sum("n_ld").alias("n_ld"),
    )
    j = per_cust.join(cust, per_cust["o_custkey"] == cust["c_custkey"], "inner")
    sums = ["n_orders", "n_of", "n_ou", "n_os", "n_lines", "n_lf", "n_lr", "n_ld"]
    agg = j.groupBy("c_nationkey").agg(*[F.sum(c).alias(c) for c in sums])
    # nation is a 25-row dimension table of the schema: bounded, broadcast.
    return agg.join(F.broadcast(nation), agg["c_nationkey"] == nation["n_nationkey"]).drop("c_nationkey")


def _pct(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) * 100.0 / F.col(b))


def corroboration_pairs(estimates: DataFrame) -> DataFrame:
    cells = F.array(
        F.struct(F.lit("institutional_delivery").alias("indicator"), _pct("n_of", "n_orders").alias("source_a"),
                 _pct("n_lf", "n_lines").alias("source_b")),
        F.struct(F.lit("full_immunization").alias("indicator"), _pct("n_ou", "n_orders").alias("source_a"),
                 _pct("n_lr", "n_lines").alias("source_b")),
        F.struct(F.lit("anc_4_plus").alias("indicator"), _pct("n_os", "n_orders").alias("source_a"),
                 _pct("n_ld", "n_lines").alias("source_b")),
        F.struct(F.lit("anaemia").alias("indicator"), _pct("n_ou", "n_orders").alias("source_a"),
                 _pct("n_ld", "n_lines").alias("source_b")),
    )
    return estimates.select("n_nationkey", "n_name", F.inline(cells))


# --- documents: completeness by source -----------------------------------------------

def labels_by_doc(labels: DataFrame) -> DataFrame:
    """Join-safe labels: one row per document (duplicates resolved by max)."""
    return labels.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"),
                                        F.count("*").alias("label_rows"))


def completeness_by_source(spark: SparkSession, sf_dir: str, scale: int = 6) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = labels_by_doc(read_table(spark, sf_dir, "labels"))
    j = docs.join(lab, "doc_id", "left")
    agg = j.groupBy("lang", "source").agg(
        F.count("*").alias("total_docs"),
        F.count("label_rows").alias("labelled_docs"),
        F.count_if(F.col("quality") == 1).alias("quality_docs"),
        F.count_if(F.col("toxic") == 1).alias("toxic_docs"),
        F.sum("n_chars").alias("_chars"),
    )
    agg = agg.withColumns({
        "_coverage": F.col("labelled_docs") / F.col("total_docs"),
        "_clean": F.when(F.col("labelled_docs") > 0, 1.0 - F.col("toxic_docs") / F.col("labelled_docs")),
    })
    dims = [Dimension("label_coverage", F.col("_coverage"), 1.0, F.lit(False)),
            Dimension("cleanliness", F.col("_clean"), 1.0, F.col("labelled_docs") < THIN_HISTORY_ORDERS)]
    return with_verdict(agg, dims, score_scale=scale, cache_key="documents_by_source").select(
        "lang", "source", "total_docs", "labelled_docs", "quality_docs", "toxic_docs",
        round_half_up(F.col("_chars") / F.col("total_docs"), scale).alias("avg_chars"),
        round_half_up(F.col("_coverage"), scale).alias("label_coverage_score"),
        round_half_up(F.col("_clean"), scale).alias("cleanliness_score"),
        *VERDICT_COLUMNS,
    )


# --- contracts ----------------------------------------------------------------------------

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
DOC_LANGS = ("de", "en", "es", "fr")


# The keys that orders, line items and customers own or refer to.
KEY_USES = {
    "orders": (KeyUse("order", ("o_orderkey",), True), KeyUse("customer", ("o_custkey",), False)),
    "lineitem": (KeyUse("line", ("l_orderkey", "l_linenumber"), True), KeyUse("order", ("l_orderkey",), False)),
    "customer": (KeyUse("customer", ("c_custkey",), True),),
}


def _row_conditions() -> dict[str, dict[str, Column]]:
    """Rows to count per table; a row on which a condition is null counts."""
    c = F.col
    return {
        "orders": {"price": c("o_totalprice") <= 0, "status": ~c("o_orderstatus").isin("F", "O", "P"),
                   "unspecified": c("o_orderpriority") == "4-NOT SPECIFIED"},
        "lineitem": {"discount": ~c("l_discount").between(0.0, 0.1), "quantity": c("l_quantity") <= 0},
        "customer": {"negative": F.coalesce(c("c_acctbal") < 0, F.lit(False))},
    }


def key_rules() -> list[Rule]:
    """Rules over the key counts of orders, line items and customers (``quality.key_counts``)."""
    place = {n: F.sum(f"f_{k}") for k, n in enumerate(n for t in _row_conditions().values() for n in t)}
    orders, customers = rows_owned("order"), rows_owned("customer")
    return [
        Rule("orders", "orders_key_unique", "fail", owned_again("order")),
        Rule("orders", "orders_totalprice_positive", "fail", place["price"]),
        Rule("orders", "orders_status_in_domain", "fail", place["status"]),
        Rule("orders", "orders_priority_specified_share", "warn", F.try_divide(orders - place["unspecified"], orders), "ge", 0.9),
        Rule("lineitem", "lineitem_discount_in_range", "fail", place["discount"]),
        Rule("lineitem", "lineitem_quantity_positive", "fail", place["quantity"]),
        Rule("lineitem", "lineitem_line_key_unique", "fail", owned_again("line")),
        Rule("customer", "customer_key_unique", "fail", owned_again("customer")),
        Rule("customer", "customer_negative_balance_share", "warn", F.try_divide(place["negative"], customers), "le", 0.05),
        Rule("lineitem_without_order", "lineitem_order_exists", "fail", used_without_owner("order")),
        Rule("orders_without_customer", "orders_customer_exists", "fail", used_without_owner("customer")),
    ]


def contract_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("events", "events_props_json_parse_rate", "warn",
             share_where(F.get_json_object(c("props"), "$.k").isNotNull()), "ge", 0.99),
        Rule("events", "events_type_in_domain", "fail", count_where(~c("event_type").isin(*EVENT_TYPES))),
        Rule("documents", "documents_length_matches_text", "warn", count_where(c("n_chars") != F.length(c("text")))),
        Rule("documents", "documents_lang_in_domain", "warn", count_where(~c("lang").isin(*DOC_LANGS))),
        Rule("labels", "labels_are_binary", "fail",
             count_where(~c("quality").isin(0, 1) | ~c("toxic").isin(0, 1))),
        Rule("labels", "labels_one_row_per_doc", "fail", duplicate_keys("doc_id")),
    ]


def contract_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = _row_conditions()
    # uniqueness, references and row rules of the keyed tables come from one table of key counts: one scan of each
    keys = key_counts({n: (read_table(spark, sf_dir, n), uses, conditions[n]) for n, uses in KEY_USES.items()})
    tables = {n: read_table(spark, sf_dir, n) for n in ("events", "documents", "labels")}
    return evaluate_compiled(keys, _compiled_keys()).unionByName(evaluate_contracts(tables, _compiled_contracts()))


@lru_cache(maxsize=1)
def _compiled_contracts():
    return compile_contracts(contract_rules())


@lru_cache(maxsize=1)
def _compiled_keys():
    return compile_rules(key_rules())


# --- monthly series ----------------------------------------------------------------------------

def nation_monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per (nation, month index); orders are counted per (customer, month)
    before the customer join, so the join is 1:1 per customer-month."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    t = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1
    per_cust = orders.groupBy("o_custkey", t.alias("month_index")).agg(F.count("*").alias("n"))
    return (per_cust.join(cust, per_cust["o_custkey"] == cust["c_custkey"])
            .groupBy(F.col("c_nationkey").alias("nation_key"), "month_index")
            .agg(F.sum("n").alias("order_count")))


def nation_monthly_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(indicator, nation_key, month_index, value): four monthly series per nation in long form.

    Orders are summed per (customer, month) before the customer join; the indicators are spread at the end, from one
    row per nation and month.
    """
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    t = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1
    per_cust = orders.groupBy("o_custkey", t.alias("month_index")).agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("urgent"),
        F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.sum(F.floor("o_totalprice")).alias("amount"))
    per = (per_cust.join(cust, per_cust["o_custkey"] == cust["c_custkey"])
           .groupBy(F.col("c_nationkey").alias("nation_key"), "month_index")
           .agg(*[F.sum(c).alias(c) for c in ("n", "urgent", "done", "amount")]))
    cells = [("order_count", F.col("n").cast("double")), ("order_value", F.col("amount").cast("double")),
             ("urgent_percent", F.col("urgent") * 100.0 / F.col("n")), ("fulfilled_percent", F.col("done") * 100.0 / F.col("n"))]
    return per.select("nation_key", "month_index", F.inline(F.array(*[
        F.struct(F.lit(i).alias("indicator"), v.alias("value")) for i, v in cells])))


# --- nation verdicts: corroboration dimensions + a weak state anchor -----------------

STATE_ANCHOR_WEIGHT = 0.5


def nation_dimensions(estimates: DataFrame) -> DataFrame:
    """Per nation, in one generator pass over the estimates:

    * corroboration per indicator: score 1 - gap / (2 x red cut-off), floored
      at 0, low confidence unless the gap band is green;
    * the nation-level fulfilment share as a weak-signal anchor of weight 0.5
      that can never make green on its own.
    """
    return estimates.select("n_nationkey", _nation_dimension_cells())


@lru_cache(maxsize=None)
def _nation_dimension_cells():
    from trustgrid.operators.corroborate import THRESHOLDS, gap_band

    pairs = {"institutional_delivery": ("n_of", "n_orders", "n_lf", "n_lines"),
             "full_immunization": ("n_ou", "n_orders", "n_lr", "n_lines"),
             "anc_4_plus": ("n_os", "n_orders", "n_ld", "n_lines")}
    cells = []
    for ordinal, (indicator, green, red) in enumerate(THRESHOLDS):
        a1, a2, b1, b2 = pairs[indicator]
        gap = F.abs(_pct(a1, a2) - _pct(b1, b2))
        score = F.greatest(F.lit(0.0), 1.0 - gap / (2.0 * red))
        cells.append(F.struct(
            F.lit(indicator).alias("dimension"), F.lit(ordinal).alias("ordinal"),
            F.coalesce(score, F.lit(0.0)).alias("score"), F.lit(1.0).alias("weight"),
            F.coalesce(gap_band(gap, F.lit(green), F.lit(red)) != "green", F.lit(True)).alias("low_confidence"),
            gap.isNull().alias("is_missing"), F.lit(False).alias("weak_signal")))
    cells.append(F.struct(
        F.lit("state_anchor").alias("dimension"), F.lit(len(THRESHOLDS)).alias("ordinal"),
        F.coalesce(F.col("n_of") / F.col("n_orders"), F.lit(0.0)).alias("score"),
        F.lit(STATE_ANCHOR_WEIGHT).alias("weight"), F.lit(False).alias("low_confidence"),
        F.lit(False).alias("is_missing"), F.lit(True).alias("weak_signal")))
    return F.inline(F.array(*cells))


# --- facility provenance -------------------------------------------------------------

def facility_provenance(facilities: DataFrame) -> DataFrame:
    """Per facility: structured field (1.0), fact found in capability text (0.6), absent (0)."""
    from trustgrid.functions.cells import is_blank_field
    from trustgrid.operators import provenance as pv

    text = pv.as_text(F.col("capability"))
    facts = facilities.select(
        "unique_id",
        (~is_blank_field(F.col("doctors"))).alias("_s_doc"),
        F.coalesce(pv.extract_count(text, pv.COUNT_PATTERNS["doctors"]).isNotNull(), F.lit(False)).alias("_e_doc"),
        (~is_blank_field(F.col("capacity"))).alias("_s_cap"),
        F.coalesce(pv.extract_count(text, pv.COUNT_PATTERNS["beds"]).isNotNull(), F.lit(False)).alias("_e_cap"),
    )
    out = facts.select(
        "unique_id",
        pv.provenance_tag(F.col("_s_doc"), F.col("_e_doc")).alias("doctors_provenance"),
        pv.provenance_confidence(F.col("_s_doc"), F.col("_e_doc")).alias("doctors_confidence"),
        pv.provenance_tag(F.col("_s_cap"), F.col("_e_cap")).alias("capacity_provenance"),
        pv.provenance_confidence(F.col("_s_cap"), F.col("_e_cap")).alias("capacity_confidence"),
    )
    return out.withColumn("provenance_confidence",
                          round_half_up((F.col("doctors_confidence") + F.col("capacity_confidence")) / 2.0, 6))
