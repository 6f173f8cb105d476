"""trustgrid: a Spark-native engine that decides whether tables can be trusted.

Messy sources are landed as strings, cells are parsed into values with explicit
flags, lookups are reduced to one row per key, and entities are scored into a
numeric score, a weakest-link band and a binding reason. Every operator is a
DataFrame / SQL plan built from built-in expressions so Catalyst can push down,
prune and codegen it.

The names below are the public API; they are imported on first use.
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_API = {
    # column expressions
    "place_key": "trustgrid.functions.text",
    "code6_in_text": "trustgrid.functions.text",
    "code6_normalise": "trustgrid.functions.text",
    "place_text_is_sane": "trustgrid.functions.text",
    "survey_value": "trustgrid.functions.cells",
    "is_suppressed": "trustgrid.functions.cells",
    "is_low_sample": "trustgrid.functions.cells",
    "is_unparsed": "trustgrid.functions.cells",
    "count_value": "trustgrid.functions.cells",
    "count_is_invalid": "trustgrid.functions.cells",
    "decimal_or_null": "trustgrid.functions.cells",
    # schema
    "to_snake_case": "trustgrid.functions.schema",
    "rename_columns": "trustgrid.functions.schema",
    "require_columns": "trustgrid.functions.schema",
    "parse_measure_heading": "trustgrid.functions.schema",
    # operators
    "melt": "trustgrid.operators.reshape",
    "melt_measures": "trustgrid.operators.reshape",
    "pivot_fixed": "trustgrid.operators.reshape",
    "join_safe_lookup": "trustgrid.operators.lookup",
    "enrich_codes": "trustgrid.operators.lookup",
    "unmatched_codes": "trustgrid.operators.lookup",
    "many_to_one_join": "trustgrid.operators.joins",
    "Dimension": "trustgrid.operators.score",
    "with_verdict": "trustgrid.operators.score",
    "trust_verdict_long": "trustgrid.operators.score",
    "score_rejects": "trustgrid.operators.score",
    "Rule": "trustgrid.operators.quality",
    "evaluate_rules": "trustgrid.operators.quality",
    "evaluate_contracts": "trustgrid.operators.quality",
    "corroboration_bands": "trustgrid.operators.corroborate",
    "rank_fixes": "trustgrid.operators.fix",
    "before_after": "trustgrid.operators.fix",
    "trend_anomalies": "trustgrid.operators.predict",
    "expected_values": "trustgrid.operators.predict",
    "rank_overall": "trustgrid.operators.fix",
    "places": "trustgrid.operators.ranking",
    "fit_trends": "trustgrid.operators.predict",
    "key_values": "trustgrid.operators.lookup",
    "key_counts": "trustgrid.operators.quality",
    "distinct_by_grain": "trustgrid.operators.quality",
    "checked_join": "trustgrid.operators.joins",
    "claim_items": "trustgrid.operators.provenance",
    "item_facts": "trustgrid.operators.provenance",
    "grid_index": "trustgrid.operators.geo",
    "assign_districts": "trustgrid.operators.geo",
    "stated_conflicts": "trustgrid.operators.geo",
    "points_in_polygons": "trustgrid.operators.geo",
    "polygon_edges": "trustgrid.operators.geo",
    "polygons_from_features": "trustgrid.operators.geo",
    "resolve_geography": "trustgrid.operators.geo",
    # sources, sinks, jobs
    "read_csv": "trustgrid.sources.io",
    "read_feature_collection": "trustgrid.sources.io",
    "read_features": "trustgrid.sources.io",
    "publish": "trustgrid.sources.publish",
    "staged": "trustgrid.sources.staging",
    "stamp_ingest": "trustgrid.sources.io",
    "preflight": "trustgrid.sources.io",
    "write_table": "trustgrid.sources.io",
    "build_all": "trustgrid.plans.pipeline",
    "start_survey_cell_stream": "trustgrid.streaming.cells",
    "start_facility_verdict_stream": "trustgrid.streaming.verdicts",
}

__all__ = sorted(_API)


def __getattr__(name: str):
    if name in _API:
        return getattr(importlib.import_module(_API[name]), name)
    raise AttributeError(f"module 'trustgrid' has no attribute {name!r}")
