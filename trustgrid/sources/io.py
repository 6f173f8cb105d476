"""Landing and publishing: CSV / JSON reads, optional sources, ingest stamps,
preflight, overwrite writes and run summaries.

Reads keep every column as a string (no inference): typing happens in the
cell parsers, where bad cells become flags instead of failed jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustgrid.functions.schema import STAMP_COLUMNS, quoted_col


# windows-1252 is ISO-8859-1 but for the bytes 0x80 to 0x9F
WINDOWS_1252 = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
WINDOWS_1252 = {c: w for c, w in WINDOWS_1252.items() if w}


def read_csv(spark: SparkSession, path: str, encoding: str = "UTF-8", multiline: bool = False,
             schema: T.StructType | None = None) -> DataFrame:
    """Header CSV with every column as string; quoted ``"`` escapes.

    ``multiline`` lets quoted cells span lines but makes each file one split,
    so it is opt-in for the sources that need it.

    Spark 4 accepts only the UTF / ASCII / ISO-8859-1 charsets. ``windows-1252``
    is read as ISO-8859-1, which gives every byte its own character, and the
    27 characters that differ are put right in headings and cells; no session
    setting is touched.
    """
    windows = encoding.lower().replace("_", "-") in ("windows-1252", "cp1252")
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("encoding", "ISO-8859-1" if windows else encoding).option("quote", '"').option("escape", '"')
              .option("multiLine", multiline).option("mode", "PERMISSIVE"))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if not windows:
        return df
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    table = str.maketrans(WINDOWS_1252)
    cells = [F.translate(quoted_col(c), "".join(WINDOWS_1252), "".join(WINDOWS_1252.values())) if c in texts else quoted_col(c)
             for c in df.columns]
    return df.select(*[cell.alias(c.translate(table)) for cell, c in zip(cells, df.columns)])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_optional_csv(spark: SparkSession, path: str, schema: T.StructType, **kw) -> DataFrame:
    """CSV when the file exists, else an empty frame with the declared schema."""
    if _exists(spark, path):
        return read_csv(spark, path, **kw)
    return spark.createDataFrame([], schema)


FEATURE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),
        ])),
    ]))),
])


def read_feature_collection(spark: SparkSession, path: str) -> DataFrame:
    """A multi-line GeoJSON FeatureCollection, exploded to one row per feature.

    Coordinates are kept as JSON text (their nesting depth differs between
    Polygon and MultiPolygon) and parsed by the geo operators.
    """
    fc = spark.read.option("multiLine", True).schema(FEATURE_SCHEMA).json(path)
    return fc.select(F.col("type").alias("collection_type"),
                     F.posexplode("features").alias("feature_index", "feature")).select(
        "collection_type", "feature_index",
        F.col("feature.properties").alias("properties"),
        F.col("feature.geometry.type").alias("geometry_type"),
        F.col("feature.geometry.coordinates").alias("coordinates_json"),
    )


def read_features(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """GeoJSON features of any shape, one row each, spread over tasks: (source_file, feature_index, collection_type,
    properties, geometry_type, coordinates_json, is_json).

    Properties may differ from feature to feature: each file (or, with ``lines``, each line of a file with one feature
    a line, which Spark can split) is parsed as a variant and ``properties`` stay one. A text that is no JSON, or no
    feature, keeps a row without geometry, so nothing is lost in silence. Features are dealt out by file and place, so
    the work after this does not stay in the task that has read a large collection.
    """
    text = spark.read.option("wholetext", not lines).text(path)
    parsed = text.select(F.col("_metadata.file_path").alias("source_file"), F.try_parse_json("value").alias("json"))
    kind = F.try_variant_get("json", "$.type", "string")
    features = F.when(kind == "Feature", F.array("json")).otherwise(F.try_variant_get("json", "$.features", "array<variant>"))
    rows = parsed.select("source_file", kind.alias("collection_type"), F.col("json").isNotNull().alias("is_json"),
                         F.posexplode_outer(features).alias("feature_index", "feature"))
    spread = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(
        "source_file", F.coalesce("feature_index", F.lit(-1)), F.try_variant_get("feature", "$", "string")))
    return spread.select(
        "source_file", "feature_index", "collection_type", F.try_variant_get("feature", "$.properties", "variant").alias("properties"),
        F.try_variant_get("feature", "$.geometry.type", "string").alias("geometry_type"),
        F.try_variant_get("feature", "$.geometry.coordinates", "string").alias("coordinates_json"), "is_json")


def feature_property(name: str) -> F.Column:
    """A property of ``read_features`` as text; null where a feature has none of that name."""
    return F.try_variant_get("properties", f"$.{name}", "string")


def feature_collection_check(features: DataFrame, name_keys: Sequence[str] = ("NAME_1", "NAME_2")) -> DataFrame:
    """Shape check: collection type, non-empty, name properties present (one aggregate)."""
    named = None
    for k in name_keys:
        c = F.coalesce(F.length(F.trim(F.try_element_at("properties", F.lit(k)))) > 0, F.lit(False))
        named = c if named is None else named & c
    return features.agg(
        F.count("*").alias("feature_count"),
        F.bool_and(F.col("collection_type") == "FeatureCollection").alias("is_feature_collection"),
        F.count_if(~named).alias("features_missing_names"),
    ).withColumn("is_valid", F.col("is_feature_collection") & (F.col("feature_count") > 0)
                 & (F.col("features_missing_names") == 0))


def stamp_ingest(df: DataFrame, source: str | None = None, layer: str = "bronze") -> DataFrame:
    """Add ``_source_file`` (per-row file path when ``source`` is None),
    ``_medallion_layer`` and ``_ingested_at_utc``."""
    src = F.lit(source) if source is not None else F.col("_metadata.file_path")
    return df.withColumns({
        STAMP_COLUMNS[0]: src,
        STAMP_COLUMNS[1]: F.lit(layer),
        STAMP_COLUMNS[2]: F.current_timestamp(),
    })


def keep_list_filter(df: DataFrame, candidates: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows whose first present candidate field, upper-cased and trimmed, is in ``keep``."""
    present = [F.col(c) for c in candidates if c in df.columns]
    if not present:
        raise ValueError(f"none of {list(candidates)} present")
    wanted = [k.strip().upper() for k in keep if k.strip()]
    return df.where(F.upper(F.trim(F.coalesce(*present))).isin(wanted))


def run_id_column(prefix: str) -> F.Column:
    """``prefix-YYYYMMDDThhmmssZ`` computed once per query."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.concat(F.lit(prefix + "-"), F.date_format(utc, "yyyyMMdd'T'HHmmss'Z'"))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table (schema replaced by the new frame's)."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if it is absent; its tables go to ``location``, or to the session's warehouse."""
    place = " LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.replace('`', '``')}`{place}")


def table_preview(tables: dict[str, DataFrame], n: int, order_by: dict[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """First ``n`` rows of each table, ordered when keys are given (deterministic)."""
    out = {}
    for name, df in tables.items():
        keys = (order_by or {}).get(name)
        out[name] = (df.orderBy(*keys) if keys else df).limit(n)
    return out


def row_count_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for many tables as one union of count aggregates (one job)."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass(frozen=True)
class SourceSpec:
    name: str
    path: str
    required: bool = True


def preflight(spark: SparkSession, sources: Sequence[SourceSpec]) -> DataFrame:
    """(source_location, source_name, status, row_count); raises if a required source is absent.

    Existence is file-system metadata; the counts of present sources are one
    union of aggregates, so all of them run as one job.
    """
    missing_required = [s.name for s in sources if s.required and not _exists(spark, s.path)]
    if missing_required:
        raise FileNotFoundError(f"required sources missing: {missing_required}")
    parts = []
    for s in sources:
        if _exists(spark, s.path):
            df = spark.read.parquet(s.path) if s.path.endswith(".parquet") else read_csv(spark, s.path)
            parts.append(df.agg(F.count("*").alias("row_count")).select(
                F.lit(s.path).alias("source_location"), F.lit(s.name).alias("source_name"),
                F.lit("present").alias("status"), "row_count"))
        else:
            parts.append(spark.range(1).select(
                F.lit(s.path).alias("source_location"), F.lit(s.name).alias("source_name"),
                F.lit("optional_missing").alias("status"), F.lit(None).cast("bigint").alias("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
