"""Mixing sources to target weights by hierarchical budgeting.

A token budget runs down a tree (domain - language - source by default). At every node it is split over the children
by weight; a child that holds less than its share is filled and its shortage goes to its siblings, again by weight,
until it is spent (water filling). A node's budget never exceeds what its subtree holds, so a shortage reaches the
level above only when the siblings are exhausted. Then each leaf takes whole epochs and, from one more epoch in
seeded order, the longest prefix of documents that fits its remaining tokens.

Tokens are counted as ceil(UTF-8 bytes / 4). Weights are whole numbers, one where none is given, and all budgets are
whole tokens, so results are exact. Null or unknown level values form the node ``none``; null texts hold no tokens.
Documents with the same id (repeated rows) stand at the same place of the order and are taken together.

DataFrame functions only. The prefix of a leaf is found from sums of small blocks of its order, so a leaf with a third
of all rows is spread over many tasks; documents meet only one row per leaf, and texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

LEVELS = ("domain", "lang", "source")
ROWS_PER_BLOCK = 256
BROADCAST_LEAVES = 10_000       # at most about 1 MB

# targets of the registered query and of the pipeline stage
DOMAIN_WEIGHTS = {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}
LANG_WEIGHTS = {"en": 4, "de": 2, "fr": 2, "es": 1}
WEIGHTS = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS}
SEED = "mix-1"


def source_domain(source: Column) -> Column:
    """The domain of a source: its number modulo four."""
    number = F.regexp_extract(source, "[0-9]+", 0)
    return F.when(number != "", F.concat(F.lit("domain"), F.pmod(F.substring(number, -9, 9).cast("long"), F.lit(4))))


def tokens(text: Column) -> Column:
    return F.coalesce(F.ceil(F.octet_length(text) / 4), F.lit(0)).cast("long")


def _weight(name: Column, table: dict[str, int]) -> Column:
    out = F.lit(1)
    for value, w in table.items():
        out = F.when(name == value, F.lit(int(w))).otherwise(out)
    return out.cast("decimal(20,0)")


def split_budget(nodes: DataFrame, parents: list[str], name: str, weights: dict[str, int]) -> DataFrame:
    """Water filling: give each row of ``nodes`` (columns: parents, name, cap, pool) its part ``budget`` of the pool."""
    nodes = nodes.withColumn("w", _weight(F.col(name), weights)).withColumn("c", F.col("cap").cast("decimal(20,0)"))
    by_ratio = [F.col("c").cast("double") / F.col("w").cast("double"), F.col(name)]
    group = Window.partitionBy(*(parents or [F.lit(0)]))
    order = group.orderBy(*by_ratio).rowsBetween(Window.unboundedPreceding, 0)
    dec = lambda c: c.cast("decimal(20,0)")
    nodes = (nodes.withColumn("c_to", dec(F.sum("c").over(order))).withColumn("w_to", dec(F.sum("w").over(order)))
             .withColumn("w_all", dec(F.sum("w").over(group)))
             .withColumn("left", dec(F.col("pool") - (F.col("c_to") - F.col("c"))))
             .withColumn("w_left", dec(F.col("w_all") - (F.col("w_to") - F.col("w"))))
             .withColumn("full", F.col("left") * F.col("w") >= F.col("c") * F.col("w_left")))
    nodes = (nodes.withColumn("spent", dec(F.sum(F.when(F.col("full"), F.col("c")).otherwise(0)).over(group)))
             .withColumn("w_full", dec(F.sum(F.when(F.col("full"), F.col("w")).otherwise(0)).over(group)))
             .withColumn("rest", dec(F.col("pool") - F.col("spent")))
             .withColumn("w_rest", dec(F.col("w_all") - F.col("w_full"))))
    # whole tokens: differences of rounded running shares, so that they add up to the rest
    share = F.expr("(rest * cast(w_to - w_full as decimal(18,0))) div w_rest"
                   " - (rest * cast(w_to - w_full - w as decimal(18,0))) div w_rest")
    return nodes.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(share).cast("long"))


def leaf_budgets(leaves: DataFrame, levels: tuple[str, ...], weights: dict[str, dict[str, int]], share: tuple[int, int],
                 max_epochs: int) -> DataFrame:
    """Rows (levels, held, leaf_rows, budget): what each leaf may take."""
    all_nodes = leaves.withColumn("cap", F.col("held") * max_epochs)
    pool = F.expr(f"cast(held * {share[0]} div {share[1]} as bigint)")
    top = all_nodes.agg(F.sum("held").alias("held"), F.sum("cap").alias("cap"))
    above = top.select(F.least(pool, F.col("cap")).alias("pool"))
    for depth, level in enumerate(levels):
        path = list(levels[:depth + 1])
        nodes = all_nodes.groupBy(*path).agg(F.sum("cap").alias("cap"))
        up = path[:-1]
        # the parents' budgets; at the root one row
        nodes = nodes.join(above, up) if up else nodes.join(F.broadcast(above))
        above = split_budget(nodes, up, level, weights.get(level, {})).select(*path, F.col("budget").alias("pool"))
    return leaves.join(above.withColumnRenamed("pool", "budget"), list(levels))


def mix_plan(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], share: tuple[int, int],
             max_epochs: int = 1, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per leaf: its levels, budget, whole epochs and ``cut``, the last place of the prefix (null: none)."""
    names = list(levels)
    rows = docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("n"),
                       *[F.coalesce(c, F.lit("none")).alias(k) for k, c in levels.items()])
    # the levels of the tree are all found from one small table
    leaves = saved(rows.groupBy(*names).agg(F.sum("n").alias("held"), F.count("*").alias("leaf_rows")), "leaves")
    plan = (leaf_budgets(leaves, tuple(names), weights, share, max_epochs)
            .withColumn("epochs", F.when(F.col("held") > 0, F.expr("budget div held")).otherwise(0).cast("int"))
            .withColumn("over", F.col("budget") - F.col("epochs") * F.col("held")))
    plan = saved(plan, "plan")
    spread = _few(plan)
    placed = (rows.join(spread, names)
              .withColumn("place", _place(seed, F.col("epochs"), F.col("id")))
              .withColumn("block", F.expr(f"cast(conv(substring(place, 1, 8), 16, 10) as bigint)"
                                          f" * (leaf_rows div {ROWS_PER_BLOCK} + 1) div 4294967296")))
    sums = placed.groupBy(*names, "block").agg(F.sum("n").alias("held_here"))
    order = Window.partitionBy(*names).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("held_here").over(order), F.lit(0))).drop("held_here")
    inside = Window.partitionBy(*names, "block").orderBy("place")
    cuts = (placed.withColumn("to", F.sum("n").over(inside)).join(sums, [*names, "block"])
            .filter(F.col("before") + F.col("to") <= F.col("over"))
            .groupBy(*names).agg(F.max("place").alias("cut")))
    return plan.join(cuts, names, "left").select(*names, "budget", "epochs", "cut")


def _place(seed: str, epoch: Column, doc: Column) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), epoch.cast("string"), F.lit(":"),
                          F.coalesce(doc.cast("string"), F.lit(""))).cast("binary"))


def _few(plan: DataFrame) -> DataFrame:
    """One row per leaf: broadcast when the count says it is small, else left to the optimizer."""
    few = plan.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    return F.broadcast(plan) if few else plan


def mix_sources(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], share: tuple[int, int],
                max_epochs: int = 1, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with mix_leaf (struct of levels), mix_budget and mix_copies: how often the mix takes the document."""
    names = list(levels)
    plan = saved(mix_plan(docs, levels, weights, share, max_epochs, seed, id_col, text_col), "mix")
    packed = plan.select(F.struct(*names).alias("mix_leaf"), F.col("budget").alias("mix_budget"),
                         F.struct("epochs", "cut").alias("mix_cut"))
    leaf = F.struct(*[F.coalesce(c, F.lit("none")).alias(k) for k, c in levels.items()])
    placed = docs.withColumn("mix_leaf", leaf).join(_few(packed), "mix_leaf")
    more = _place(seed, F.col("mix_cut.epochs"), F.col(id_col)) <= F.col("mix_cut.cut")
    copies = F.col("mix_cut.epochs") + F.coalesce(more, F.lit(False)).cast("int")
    return placed.withColumn("mix_copies", copies.cast("int")).drop("mix_cut")


def document_levels() -> dict[str, Column]:
    return {"domain": source_domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def op8_source_mixing(docs: DataFrame) -> DataFrame:
    """How often each document enters a mix of half the corpus, at most two epochs of a leaf."""
    mixed = mix_sources(docs, document_levels(), WEIGHTS, (1, 2), max_epochs=2)
    return mixed.select("doc_id", F.col("mix_leaf.domain").alias("domain"), F.col("mix_leaf.lang").alias("lang"),
                        F.col("mix_leaf.source").alias("source"), tokens(F.col("text")).alias("n_tokens"),
                        F.col("mix_budget").alias("leaf_budget"), F.col("mix_copies").alias("copies"))


def _level_sql(level: str, path: list[str], weight: str) -> str:
    """DuckDB: the budgets of one level of the tree, from the budgets of the level above."""
    up = path[:-1]
    group = f"PARTITION BY {', '.join(up)} " if up else ""
    own = ", ".join(path)
    return f"""
n_{level} AS (SELECT {own}, sum(cap)::HUGEINT AS cap FROM leaves GROUP BY ALL),
o_{level} AS (SELECT n.*, p.pool::HUGEINT AS pool, ({weight})::HUGEINT AS w
    FROM n_{level} n JOIN b_{path[-2] if up else 'root'} p {f"USING ({', '.join(up)})" if up else 'ON true'}),
r_{level} AS (SELECT *, sum(cap) OVER q AS c_to, sum(w) OVER q AS w_to, sum(w) OVER ({group}) AS w_all FROM o_{level}
    WINDOW q AS ({group}ORDER BY cap::DOUBLE / w::DOUBLE, {level} ROWS UNBOUNDED PRECEDING)),
f_{level} AS (SELECT *, (pool - (c_to - cap)) * w >= cap * (w_all - (w_to - w)) AS is_full FROM r_{level}),
g_{level} AS (SELECT *, pool - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({group}) AS rest,
    sum(CASE WHEN is_full THEN w ELSE 0 END) OVER ({group}) AS w_full FROM f_{level}),
b_{level} AS (SELECT {own}, CASE WHEN is_full THEN cap
    ELSE (rest * (w_to - w_full)) // (w_all - w_full) - (rest * (w_to - w_full - w)) // (w_all - w_full) END AS pool
    FROM g_{level})"""


def _case(col: str, table: dict[str, int]) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items()) + " ELSE 1 END"


def op8_sql() -> str:
    levels = list(LEVELS)
    weights = {"domain": _case("domain", DOMAIN_WEIGHTS), "lang": _case("lang", LANG_WEIGHTS), "source": "1"}
    steps = ",".join(_level_sql(k, levels[:i + 1], weights[k]) for i, k in enumerate(levels))
    return f"""
WITH rows_ AS (SELECT doc_id, CAST(coalesce(ceil(octet_length(encode(text)) / 4), 0) AS BIGINT) AS n_tokens,
    coalesce('domain' || (CAST(right(nullif(regexp_extract(source, '[0-9]+'), ''), 9) AS BIGINT) % 4), 'none') AS domain,
    coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS held, sum(n_tokens) * 2 AS cap FROM rows_ GROUP BY ALL),
b_root AS (SELECT least(sum(held) // 2, sum(cap)) AS pool FROM leaves),{steps},
plan AS (SELECT domain, lang, source, pool AS budget, CASE WHEN held > 0 THEN pool // held ELSE 0 END AS epochs, held
    FROM b_source JOIN leaves USING (domain, lang, source)),
placed AS (SELECT r.*, budget, epochs, budget - epochs * held AS over_,
    md5('{SEED}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
    FROM rows_ r JOIN plan USING (domain, lang, source)),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, CAST(budget AS BIGINT) AS leaf_budget,
    CAST(epochs + CASE WHEN upto <= over_ THEN 1 ELSE 0 END AS INTEGER) AS copies FROM run"""
