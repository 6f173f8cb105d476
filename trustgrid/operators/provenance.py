"""Rule-based fact extraction from free text, with provenance confidence.

Structured field present = 1.0, value recovered from text = 0.6, absent = 0.
Text may be a JSON list of strings or plain text; the whole text is always
scanned (no prefixes). All patterns are built-in regex expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgrid.operators.score import capped_rank, rank_band, round_half_up, score_rank

# Confidence levels and extraction patterns.
CONFIDENCE_STRUCTURED = 1.0
CONFIDENCE_EXTRACTED = 0.6
CONFIDENCE_ABSENT = 0.0

# Oracle-side (case-insensitive regex) forms of the rules below.
COUNT_PATTERNS = {
    "beds": r"(?i)([0-9]+)\s*(?:-\s*)?(?:beds?|bedded)",
    "doctors": r"(?i)([0-9]+)\s*(?:doctors?|physicians?)",
}
FLAG_PATTERNS = {
    "emergency_24_7": r"(?i)24\s*[/x]\s*7|round[- ]the[- ]clock",
    "nicu": r"(?i)nicu|neonatal intensive",
    "accreditation": r"(?i)accredit|licen[cs]e",
}


def as_text(col: Column) -> Column:
    """A JSON list of strings becomes its items joined by newlines; other text stays."""
    looks_like_list = col.rlike(r"^\s*\[")   # anchored: stops at the first non-space character
    items = F.from_json(col, "array<string>", {"mode": "PERMISSIVE"})
    return F.when(looks_like_list, F.coalesce(F.array_join(items, "\n"), col)).otherwise(col)


def extract_count(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("bigint")


def extract_flag(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(pattern), F.lit(False))


def provenance_confidence(structured_present: Column, extracted_present: Column) -> Column:
    return (F.when(F.coalesce(structured_present, F.lit(False)), F.lit(CONFIDENCE_STRUCTURED))
            .when(F.coalesce(extracted_present, F.lit(False)), F.lit(CONFIDENCE_EXTRACTED))
            .otherwise(F.lit(CONFIDENCE_ABSENT)))


def provenance_tag(structured_present: Column, extracted_present: Column) -> Column:
    return (F.when(F.coalesce(structured_present, F.lit(False)), F.lit("structured"))
            .when(F.coalesce(extracted_present, F.lit(False)), F.lit("extracted"))
            .otherwise(F.lit("absent")))


# The same rules on lower-cased text. Keywords are plain
# substring tests (no regex); the numeric facts run their regex only on
# texts that contain the keyword at all.
COUNT_RULES = {
    "beds": (("bed",), r"([0-9]+)\s*(?:-\s*)?(?:beds?|bedded)"),
    "doctors": (("doctor", "physician"), r"([0-9]+)\s*(?:doctors?|physicians?)"),
}
FLAG_RULES = {
    "emergency_24_7": (("24", "round"), r"24\s*[/x]\s*7|round[- ]the[- ]clock"),
    "nicu": (("nicu", "neonatal intensive"), None),
    "accreditation": (("accredit", "licence", "license"), None),
}


# --- facts from lists of claims -------------------------------------------------------------

def claim_items(df: DataFrame, text_col: str, keep: Sequence[str]) -> DataFrame:
    """(keep, item_pos, item): one row per item of a JSON list of claims, whatever the items are.

    The text is parsed once, as a variant, so a list may mix texts, numbers, objects and lists; texts come as they are,
    other items as JSON text (a pattern finds its words in either), null items and an empty list give no row. A single
    JSON text is one item, and so is everything that is no list: an object, plain text, a list that breaks off.
    """
    items = F.try_variant_get("__json", "$", "array<variant>")
    texts = F.transform(items, lambda x: F.try_variant_get(x, "$", "string"))
    single = F.coalesce(F.when(F.col(text_col).rlike(r'^\s*"'), F.try_variant_get("__json", "$", "string")), F.col(text_col))
    parsed = df.select(*keep, text_col, F.try_parse_json(text_col).alias("__json"))
    return (parsed.select(*keep, F.posexplode(F.coalesce(texts, F.array(single))).alias("item_pos", "item"))
            .where(F.col("item").isNotNull()))


def item_facts(items: DataFrame, keep: Sequence[str], text_col: str = "item") -> DataFrame:
    """(keep, fact, amount): one row per fact that an item's text states; ``amount`` for counted facts only."""
    lowered = items.select(*keep, F.lower(text_col).alias("__text"))
    found = lowered.select(*keep, *fact_columns(F.col("__text")))
    none = F.lit(None).cast("bigint")
    cells = [F.when(F.col(f).isNotNull(), F.struct(F.lit(f).alias("fact"), F.col(f).alias("amount"))) for f in COUNT_RULES]
    cells += [F.when(F.col(f), F.struct(F.lit(f).alias("fact"), none.alias("amount"))) for f in FLAG_RULES]
    return found.select(*keep, F.inline(F.filter(F.array(*cells), lambda c: c.isNotNull())))


def entity_facts(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, fact): its largest amount and the number of items that state it."""
    return facts.groupBy(*keys, "fact").agg(F.max("amount").alias("amount"), F.count("*").alias("items"))


def fact_profile(entities: DataFrame, facts: DataFrame, key: str, structured: Mapping[str, Column]) -> DataFrame:
    """One row per entity: provenance and confidence of every fact, and what they say together.

    ``structured`` maps a fact to the condition that the entity has it as a field; other facts can be extracted only.
    ``fact_confidence`` is the mean over all facts; an entity with any fact that is inferred or absent stays at amber.
    """
    names = [*COUNT_RULES, *FLAG_RULES]
    stated = facts.groupBy(key).agg(*[F.count_if(F.col("fact") == f).alias(f"__{f}") for f in names])
    joined = entities.select(key, *[structured.get(f, F.lit(False)).alias(f"__s_{f}") for f in names]).join(stated, key, "left")
    has = {f: F.coalesce(F.col(f"__{f}") > 0, F.lit(False)) for f in names}
    tags = {f"{f}_provenance": provenance_tag(F.col(f"__s_{f}"), has[f]) for f in names}
    confidence = sum((provenance_confidence(F.col(f"__s_{f}"), has[f]) for f in names), F.lit(0.0)) / len(names)
    out = joined.select(key, *[c.alias(n) for n, c in tags.items()], confidence.alias("__mean"))
    inferred = sum((F.when(F.col(n) == "extracted", 1).otherwise(0) for n in tags), F.lit(0))
    absent = sum((F.when(F.col(n) == "absent", 1).otherwise(0) for n in tags), F.lit(0))
    counted = out.withColumns({"inferred_facts": inferred, "absent_facts": absent})
    return counted.withColumns({
        "fact_confidence": round_half_up(F.col("__mean"), 6),
        "fact_band": rank_band(capped_rank(score_rank(F.col("__mean")), F.lit(2),
                                           (F.col("inferred_facts") > 0) | (F.col("absent_facts") > 0))),
    }).drop("__mean")


def _any_contains(lowered: Column, words) -> Column:
    out = None
    for w in words:
        c = lowered.contains(w)
        out = c if out is None else out | c
    return out


def fact_columns(lowered: Column) -> list[Column]:
    """beds, doctors, emergency_24_7, nicu, accreditation from a lower-cased text column."""
    cols = []
    for name, (words, pattern) in COUNT_RULES.items():
        cols.append(F.when(_any_contains(lowered, words), extract_count(lowered, pattern)).alias(name))
    for name, (words, pattern) in FLAG_RULES.items():
        hit = _any_contains(lowered, words)
        if pattern is not None:
            hit = hit & lowered.rlike(pattern)
        cols.append(F.coalesce(hit, F.lit(False)).alias(name))
    return cols
