"""Every operator and every stage of the pipeline on nulls, empty and long texts, ties, repeated rows, empty tables and
extra columns whose names clash with the operators' own; the pipeline as a whole; workers without the repository."""

import os
import subprocess
import sys
import textwrap

import pytest

import corpus_pipeline
from trustgrid.llm.queries import QUERIES

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("key", "_key", "doc", "hash", "score", "lang_pred", "fit", "grp", "pos", "mix_leaf", "mix_copies", "shard", "slot",
           "spans", "entities", "clean_text", "digest", "component_id")
STAGED = 4


def sentence(i: int, n: int = 60) -> str:
    vocabulary = {"en": "the house stands on a small hill near our river and many people walk there every day",
                  "de": "das haus steht auf einem kleinen hügel nahe dem fluss und viele leute gehen dort jeden tag"}
    words = vocabulary["en" if i % 2 else "de"].split()
    return " ".join(words[(i * 7 + k * (1 + i % 5)) % len(words)] + (str(i) if k % 9 == 0 else "") for k in range(n))


def rows(n: int = 60) -> list[tuple]:
    out = []
    for i in range(n):
        text = None if i % 13 == 4 else "" if i % 17 == 6 else " \n\t" if i == 9 else sentence(i, 4000 if i == 30 else 60)
        out.append((i, text, None if i % 6 == 2 else ("en" if i % 2 else "de"), None if i % 7 == 1 else f"src{i % 3}",
                    None if i % 5 == 0 else len(text or "")))
    out += [out[3], out[3], (8, sentence(81), "en", "src1", 1), (None, sentence(3), "en", None, None), (None, None, None, None, None)]
    return out


def docs(spark, data=None):
    df = spark.createDataFrame(rows() if data is None else data, COLUMNS)
    return df.selectExpr("*", *[f"concat('kept ', doc_id) AS {c}" for c in CLASHES])


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """A folder of edge rows and one of empty tables, with benchmark, labels and conversations."""
    made = {}
    for name in ("edge", "empty"):
        base = str(tmp_path_factory.mktemp(name))
        keep = None if name == "edge" else []
        docs(spark, keep).write.parquet(f"{base}/documents.parquet")
        tables = {
            "labels": ([(i, i % 2, 0) for i in range(40)] + [(3, 0, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int"),
            "benchmark": ([(1, sentence(5)), (2, None), (3, ""), (None, "a one line item that nobody holds")], "item_id long, text string"),
            "conversations": ([(c, t, "user", sentence(c)) for c in range(4) for t in range(3)] + [(None, None, None, None), (1, None, None, None)],
                              "conv_id long, turn long, role string, text string"),
        }
        for table, (data, schema) in tables.items():
            spark.createDataFrame(data if name == "edge" else [], schema).write.parquet(f"{base}/{table}.parquet")
        made[name] = base
    return made


ONE_ROW_EACH = ("op1_", "op2_", "op3_", "op4_", "op5_", "op6_", "op8_", "op9_", "op11_", "op12_")


@pytest.mark.parametrize("name", QUERIES)
def test_query_on_edge_rows_and_on_nothing(spark, folders, name):
    got = QUERIES[name](spark, folders["edge"]).collect()
    if name.startswith(ONE_ROW_EACH):
        assert len(got) == len(rows())
        assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(r[0] for r in rows() if r[0] is not None)
        again = [tuple(r) for r in got if r["doc_id"] == 3]
        if not name.startswith(("op5_", "op9_")):           # op5 looks at the next row, op9 gives every row its own slot
            assert len(set(again)) == 1                     # repeated rows have equal results
    assert QUERIES[name](spark, folders["empty"]).collect() == []


def test_stages_on_edge_rows_keep_columns_that_clash(spark, folders):
    given = spark.read.parquet(f"{folders['edge']}/documents.parquet")
    whole = {tuple(map(repr, r)) for r in given.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, given, folders["edge"])
        assert out.columns == given.columns, name
        assert {tuple(map(repr, r)) for r in out.collect()} <= whole, name
    last = corpus_pipeline.STAGES[-1][1](spark, given, folders["edge"])
    assert last.count() == given.count()


def test_stages_on_nothing(spark, folders):
    given = spark.read.parquet(f"{folders['empty']}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, given, folders["empty"]).collect() == [], name
    assert corpus_pipeline.run(spark, folders["empty"]).collect() == []


def test_whole_pipeline_equals_its_stages(spark, folders):
    now = spark.read.parquet(f"{folders['edge']}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:STAGED]:
        now = spark.createDataFrame(stage(spark, now, folders["edge"]).collect(), now.schema)
    want = sorted(r["doc_id"] for r in now.collect() if r["doc_id"] is not None)
    got = corpus_pipeline.run(spark, folders["edge"])
    assert sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None) == want and want
    texts = [r["text"] for r in now.collect()]
    assert len(texts) == len(set(texts)) and all(t and t.strip() for t in texts)   # no null, blank or repeated text is left


def test_workers_need_no_repository(scratch):
    """op1, op2 and the new operators run where the workers' path does not hold this package."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
        import sys
        sys.path.insert(0, {repo!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").getOrCreate())
        def absent(batches):
            import importlib.util, pyarrow as pa
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("trustgrid") is None] * b.num_rows)], names=["absent"])
        assert spark.range(1).mapInArrow(absent, "absent boolean").first()[0]
        from trustgrid.llm.queries import QUERIES
        for name in ("op1_quality_trees", "op2_language_id", "op11_merkle_manifest", "op12_superkmer_dedup"):
            assert QUERIES[name](spark, "/root/testdata/sf0.001").count() == 200, name
        assert QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.001").count() > 0
        print("all ran")
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=scratch, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-2000:]
