"""The pipeline's self-checks: rules over the silver outputs, statuses computed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgrid.operators.quality import Rule, duplicate_keys, evaluate_contracts
from trustgrid.plans.silver import FACILITY_COLUMNS

OFFICE_REQUIRED = ("district", "latitude", "longitude", "pincode", "statename")


def pipeline_rules(facility_source_columns: Sequence[str], office_source_columns: Sequence[str]) -> list[Rule]:
    """Nine checks; column presence is schema metadata, compared as a literal."""
    fac_present = float(len(set(FACILITY_COLUMNS) & set(facility_source_columns)))
    off_present = float(len(set(OFFICE_REQUIRED) & set(office_source_columns)))
    c = F.col
    return [
        Rule("facilities", "facilities_required_columns_present", "fail", F.lit(fac_present), "eq",
             len(FACILITY_COLUMNS)),
        Rule("facilities", "facilities_valid_coordinate_count", "fail", F.count_if(c("has_valid_coordinates")), "ge", 1),
        Rule("offices", "offices_required_columns_present", "fail", F.lit(off_present), "eq", len(OFFICE_REQUIRED)),
        Rule("offices", "offices_invalid_code_count", "warn", F.count_if(~c("is_valid_code")), "eq", 0),
        Rule("lookup", "code_lookup_is_unique", "fail", duplicate_keys("pincode")),
        Rule("survey", "survey_indicator_columns_detected", "fail", F.countDistinct("indicator"), "ge", 1),
        Rule("admin", "admin_state_grain_detected", "fail", F.countDistinct("state_key"), "ge", 1),
        Rule("admin", "admin_invalid_numeric_count", "warn", F.count_if(c("is_invalid_numeric")), "eq", 0),
        Rule("admin_totals", "admin_curated_indicator_count", "warn", F.countDistinct("indicator_name"), "eq", 7),
    ]


def pipeline_checks(facility_source_columns: Sequence[str], office_source_columns: Sequence[str],
                    silver: dict[str, DataFrame]) -> DataFrame:
    """``silver``: facilities, offices, lookup, survey, admin, admin_totals frames."""
    return evaluate_contracts(silver, pipeline_rules(facility_source_columns, office_source_columns))
