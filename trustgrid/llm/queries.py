"""Queries of the corpus operators: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from .bin_packing import op9_bin_packing
from .common import documents
from .decontaminate import op10_decontaminate
from .language_id import op2_language_id
from .lz_fingerprint import op5_lz_fingerprint
from .pii_surrogates import op3_pii_surrogates
from .merkle_manifest import op11_merkle_manifest, op11_sql
from .prefix_trie import op13_prefix_trie, op13_sql
from .quality_trees import op1_quality_trees
from .secret_scan import op6_secret_scan
from .shingle_join import op7_shingle_join
from .source_mixing import op8_source_mixing, op8_sql
from .suffix_dedup import op4_suffix_dedup
from .superkmer_dedup import op12_sql, op12_superkmer_dedup


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


QUERIES = {
    "op1_quality_trees": lambda s, d: op1_quality_trees(documents(s, d), _table(s, d, "labels")),
    "op2_language_id": lambda s, d: op2_language_id(documents(s, d)),
    "op3_pii_surrogates": lambda s, d: op3_pii_surrogates(documents(s, d)),
    "op4_suffix_dedup": lambda s, d: op4_suffix_dedup(documents(s, d)),
    "op5_lz_fingerprint": lambda s, d: op5_lz_fingerprint(documents(s, d)),
    "op6_secret_scan": lambda s, d: op6_secret_scan(documents(s, d)),
    "op7_shingle_join": lambda s, d: op7_shingle_join(documents(s, d)),
    "op8_source_mixing": lambda s, d: op8_source_mixing(documents(s, d)),
    "op9_bin_packing": lambda s, d: op9_bin_packing(documents(s, d)),
    "op10_decontaminate": lambda s, d: op10_decontaminate(documents(s, d), _table(s, d, "benchmark")),
    "op11_merkle_manifest": lambda s, d: op11_merkle_manifest(documents(s, d)),
    "op12_superkmer_dedup": lambda s, d: op12_superkmer_dedup(documents(s, d)),
    "op13_prefix_trie": lambda s, d: op13_prefix_trie(_table(s, d, "conversations")),
}

ORACLES = {"op8_source_mixing": op8_sql(), "op11_merkle_manifest": op11_sql(),
           "op12_superkmer_dedup": op12_sql(), "op13_prefix_trie": op13_sql()}
