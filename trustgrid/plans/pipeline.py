"""The batch job end to end: land (bronze) -> typed and flagged (silver) ->
verdicts (gold) -> checks, each layer written as Parquet and read back.

Writing a layer and reading it back cuts the lineage: a lost executor
recomputes at most one layer from its written input, never the whole chain.
Tables go under the shared folder named by ``spark.checkpoint.dir`` (or an
explicit ``out_dir``); row counts are captured with ``observe`` while each
table is written, so no extra count job runs.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trustgrid.operators import lookup as lk
from trustgrid.operators.score import trust_verdict_long
from trustgrid.plans import entities as ent
from trustgrid.plans import gold, silver
from trustgrid.plans.checks import pipeline_checks
from trustgrid.session import CHECKPOINT_CONF
from trustgrid.sources import fixtures as fx
from trustgrid.sources.io import stamp_ingest, write_table


# Long silver tables are partitioned by a low-cardinality column that later
# reads filter on, so those reads prune whole directories.
PARTITIONS = {
    "silver_survey_cells": ("indicator",),
    "silver_admin_long": ("value_type",),
}


def _write(spark: SparkSession, df: DataFrame, base: str, name: str, summary: list) -> DataFrame:
    path = os.path.join(base, name)
    obs = Observation(name)
    write_table(df.observe(obs, F.count(F.lit(1)).alias("row_count")), path, PARTITIONS.get(name, ()))
    summary.append((name, int(obs.get["row_count"]), path))
    return spark.read.parquet(path)


# Silver tables joined again in gold on the district key: written bucketed
# (same keys, same bucket count) so the gold join reads co-located buckets
# instead of shuffling both sides.
BUCKETED = {
    "silver_survey_districts": ("state_key", "district_key"),
    "silver_postal_summary": ("state_key", "district_key"),
}


def _write_bucketed(spark: SparkSession, df: DataFrame, base: str, name: str, summary: list, database: str,
                    buckets: int) -> DataFrame:
    path = os.path.join(base, name)
    obs = Observation(name)
    keys = BUCKETED[name]
    (df.observe(obs, F.count(F.lit(1)).alias("row_count")).write.mode("overwrite").format("parquet")
     .option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(f"`{database}`.`{name}`"))
    summary.append((name, int(obs.get["row_count"]), path))
    return spark.table(f"`{database}`.`{name}`")


def build_all(spark: SparkSession, sf_dir: str, out_dir: str | None = None, run_id: str | None = None,
              buckets: int | None = None) -> DataFrame:
    """Run every layer; return the run summary (table_name, row_count, path, run_id).

    ``buckets``: write the district-keyed silver tables as bucketed catalog
    tables (external, under ``out_dir``) so the gold district join is
    shuffle-free.
    """
    run_id = run_id or "run-" + dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    if out_dir is None:
        root = spark.conf.get(CHECKPOINT_CONF, None)
        if not root:
            raise ValueError(f"pass out_dir or set {CHECKPOINT_CONF} to a shared folder")
        out_dir = os.path.join(root, "trustgrid", run_id)
    summary: list = []

    database = "trustgrid_" + "".join(ch if ch.isalnum() else "_" for ch in run_id).lower()
    if buckets:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    def w(df, name):
        if buckets and name in BUCKETED:
            return _write_bucketed(spark, df, out_dir, name, summary, database, buckets)
        return _write(spark, df, out_dir, name, summary)

    # bronze: sources as landed (strings), stamped
    b_fac = w(stamp_ingest(fx.view(spark, sf_dir, "v_facilities"), "facilities"), "bronze_facilities")
    b_off = w(stamp_ingest(fx.view(spark, sf_dir, "v_offices"), "postal_directory"), "bronze_postal_directory")
    b_survey = w(silver.survey_landed(spark, sf_dir), "bronze_survey_indicators")
    b_admin = w(stamp_ingest(silver.admin_landed(spark, sf_dir), "admin_counts"), "bronze_admin_counts")

    # silver
    s_fac = w(silver.facility_geo(b_fac), "silver_facilities_geo")
    s_off = w(silver.offices_silver(b_off), "silver_post_offices")
    s_lookup = w(lk.join_safe_lookup(s_off, "pincode", "district_key", "state_key", "district_name", "state_name",
                                     "has_coordinates"), "silver_code_lookup")
    s_cells = w(silver.survey_cells(b_survey), "silver_survey_cells")
    s_districts = w(silver.survey_districts(s_cells), "silver_survey_districts")
    s_admin = w(silver.admin_long(b_admin), "silver_admin_long")
    s_totals = w(silver.admin_totals(b_admin), "silver_admin_totals")
    s_postal = w(silver.postal_summary(s_off), "silver_postal_summary")

    # gold
    w(gold.facility_verdicts(s_fac), "gold_facility_verdicts")
    ctx = w(gold.district_context(s_districts, s_postal), "gold_district_context")
    w(gold.need_ranking(ctx), "gold_need_ranking")
    w(gold.code_enrichment(s_lookup, s_districts), "gold_code_enrichment")
    w(gold.state_summary(s_totals), "gold_state_summary")
    w(trust_verdict_long(gold.district_dimensions(s_districts, s_postal), ["state_key", "district_key"]),
      "gold_district_verdicts")
    w(ent.customer_verdicts(spark, sf_dir), "gold_customer_verdicts")

    # checks over the written silver tables (one aggregation per table)
    w(pipeline_checks(b_fac.columns, b_off.columns, {
        "facilities": s_fac, "offices": s_off, "lookup": s_lookup, "survey": s_cells,
        "admin": s_admin, "admin_totals": s_totals,
    }), "pipeline_quality_checks")

    out = spark.createDataFrame(summary, "table_name string, row_count long, path string").withColumn(
        "run_id", F.lit(run_id))
    write_table(out, os.path.join(out_dir, "pipeline_run_summary"))
    return out
