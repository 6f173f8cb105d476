"""Text normalisation expressions: place keys, postal codes, name sanity.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen and runs on batch and streaming frames.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = "\u00a0"

# Code points folded to ASCII. The table is generated from Unicode's NFKD
# decomposition (a rule, not a hand list): Latin-1 supplement, Latin
# Extended-A/B, Latin Extended Additional, general punctuation / spaces and
# full-width forms.
_FOLD_RANGES = ((0x00A0, 0x0250), (0x1E00, 0x1F00), (0x2000, 0x2070), (0xFF00, 0xFFF0))


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Build (matching, replacement, multi-char pairs) for accent folding.

    Characters whose NFKD form is one ASCII character go through one
    ``translate`` (ASCII whitespace is mapped to a space in the same pass);
    characters with no ASCII form are deleted by the same ``translate``
    (they sit past the end of the replacement string); the few that
    decompose to several ASCII letters (ligatures, fractions) use ``replace``.
    """
    singles_from, singles_to, deletes, multis = list("\t\n\x0b\f\r"), list("     "), [], []
    for lo, hi in _FOLD_RANGES:
        for cp in range(lo, hi):
            ch = chr(cp)
            folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
            if folded == ch:
                continue
            if len(folded) == 1:
                singles_from.append(ch)
                singles_to.append(folded)
            elif folded == "":
                deletes.append(ch)
            else:
                multis.append((ch, folded))
    return "".join(singles_from) + "".join(deletes), "".join(singles_to), tuple(multis)


def fold_accents(col: Column) -> Column:
    """NFKD-to-ASCII folding without a UDF (``Bengalūru`` -> ``Bengaluru``);
    ASCII whitespace becomes a space.

    One ``translate`` handles single-letter folds and deletions; the chain
    of ``replace`` calls for multi-letter folds only runs on the rare rows
    that hold such a character (found by a second, deleting ``translate``).
    """
    matching, replacement, multis = _fold_tables()
    out = F.translate(col, matching, replacement)
    chain = out
    for src, dst in multis:
        chain = F.replace(chain, F.lit(src), F.lit(dst))
    multi_chars = "".join(src for src, _ in multis)
    has_multi = F.length(F.translate(out, multi_chars, "")) != F.length(out)
    return F.when(has_multi, chain).otherwise(out)


def collapse_spaces(col: Column) -> Column:
    """NBSP and any whitespace run -> one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(col, NBSP, " "), r"\s+", " "))


def _sql_lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


@lru_cache(maxsize=1)
def _place_key_template() -> str:
    matching, replacement, multis = _fold_tables()
    t = f"translate({{x}}, {_sql_lit(matching)}, {_sql_lit(replacement)})"
    chain = "{t}"
    for src, dst in multis:
        chain = f"replace({chain}, {_sql_lit(src)}, {_sql_lit(dst)})"
    multi_chars = _sql_lit("".join(src for src, _ in multis))
    folded = (f"CASE WHEN length(translate({{t}}, {multi_chars}, '')) != length({{t}}) "
              f"THEN {chain} ELSE {{t}} END").replace("{t}", t)
    x = f"replace(lower({folded}), '&', ' and ')"
    x = f"regexp_replace({x}, '[^0-9a-z ]+', '')"
    x = f"trim(regexp_replace({x}, ' {{2,}}', ' '))"
    return f"nullif({x}, '')"


def place_key(col: Column | str) -> Column:
    """Canonical join key for district / state names (one rule everywhere).

    fold accents (whitespace to space) -> lower -> ``&`` to `` and `` ->
    drop everything but ``[0-9a-z ]`` -> collapse spaces (last) -> trim ->
    empty becomes null. ``  South-West & Delhi `` -> ``southwest and delhi``.
    Given a column *name*, the rule is parsed from one SQL expression (one
    call to the JVM instead of ~100 while the plan is built).
    """
    if isinstance(col, str):
        return F.expr(_place_key_template().replace("{x}", "`" + col.replace("`", "``") + "`"))
    s = F.lower(fold_accents(col))
    s = F.replace(s, F.lit("&"), F.lit(" and "))
    s = F.regexp_replace(s, r"[^0-9a-z ]+", "")
    s = F.trim(F.regexp_replace(s, r" {2,}", " "))
    return F.nullif(s, F.lit(""))


def code6_in_text(col: Column) -> Column:
    """A stand-alone six-digit code inside free text, else null.

    ``PIN 560001`` -> ``560001``; a longer digit run is not cut to six.
    """
    padded = F.concat(F.lit(" "), col, F.lit(" "))
    found = F.regexp_extract(padded, r"[^0-9]([0-9]{6})[^0-9]", 1)
    return F.nullif(found, F.lit(""))


def code6_normalise(col: Column) -> Column:
    """First digit run, zero-padded to six; null unless it has 1-6 digits."""
    digits = F.regexp_extract(col, r"[0-9]+", 0)
    return F.when(F.length(digits).between(1, 6), F.lpad(digits, 6, "0"))


def strip_quotes(col: Column) -> Column:
    """Serial numbers arrive as ``'1.1'``: trim and drop single quotes."""
    return F.regexp_replace(F.trim(col), "'", "")


def place_text_is_sane(col: Column) -> Column:
    """Name looks like a place: not null / 'null', no JSON, not all digits, has a letter."""
    return F.coalesce(
        col.isNotNull()
        & (F.lower(col) != F.lit("null"))
        & ~col.startswith("{")
        & ~col.contains("coordinates")
        & ~col.rlike(r"^[0-9]+$")
        & col.rlike(r"[A-Za-z]"),
        F.lit(False),
    )


def contains_ci(cols: list[Column], query: str) -> Column:
    """Case-insensitive substring search over several columns (or-ed)."""
    q = query.strip().lower()
    if not q:
        return F.lit(True)
    hits = [F.coalesce(F.lower(c).contains(q), F.lit(False)) for c in cols]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out
