import duckdb

import __spark_entry__ as E
from trustgrid.plans.catalog import REGISTRY
from trustgrid.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "band" in df.columns and "numeric_score" in df.columns


def test_every_query_has_unique_name_and_oracle_keys_subset():
    q = E.queries()
    o = E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 20


def test_oracle_sql_runs_on_duckdb():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    for name, sql in E.oracle_sql().items():
        con.execute(sql).fetchall()


REPORT_PAGES = {"lowest_verdicts", "facility_scorecard", "ambiguous_queue", "top_need_districts", "most_flagged_districts", "state_summary_page", "catalog_preview"}


def test_views_read_whole_tables():
    from trustgrid.sources import fixtures as fx
    texts = list(fx.VIEWS.values()) + [fx.V_SURVEY_WIDE, fx.V_ADMIN_CELLS_SPARK]
    for sql in texts:
        assert " WHERE " not in sql.upper().replace("\n", " ")   # no id subsets or modulo filters


def test_limits_only_on_report_pages():
    import re
    for name, sql in E.oracle_sql().items():
        if re.search(r"\bLIMIT\b", sql):
            assert name in REPORT_PAGES, name


def test_limits_in_spark_plans_only_on_report_pages(spark):
    for name, q in REGISTRY.items():
        plan = q.build(spark, SF)._jdf.queryExecution().analyzed().toString()
        if "GlobalLimit" in plan:
            assert name in REPORT_PAGES, name


GROWING = ("customer", "part", "orders", "lineitem", "documents", "labels", "events", "supplier",
           "conversations", "pages", "embeddings")


def test_every_query_reads_a_growing_table(spark):
    import os
    for name, build in ((n, q.build) for n, q in REGISTRY.items()):
        files = build(spark, SF).inputFiles()
        tables = {os.path.basename(f).split(".")[0] for f in files}
        # or a table that the query has derived from them and staged in the shared folder
        staged = any(spark.conf.get("spark.checkpoint.dir").split(":")[-1] in f for f in files)
        assert tables & set(GROWING) or staged, (name, tables)
