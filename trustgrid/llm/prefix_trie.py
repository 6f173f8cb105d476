"""Prefix trie of conversations by fixed-length block hashing.

A node is a distinct sequence of a conversation's first d turns; the textless root is depth 0. Every conversation is a
row of blocks of ``BLOCK`` turns. A block's digest is the exclusive or of the hashes of (place, turn) in it, so the
digest of any prefix is the exclusive or of its blocks' digests (two words of 64 bits). Conversations are grouped block
by block: (prefix before the block, block) with a count and the smallest member. Only where one prefix is followed by
several different blocks are turn boundaries looked at: those blocks are spread into turns and grouped again. Where a
prefix is followed by one block only, its turns are a chain and taken as they are.

A node is owned by its smallest member, and what a node adds to the sums of its ancestors travels along that one
conversation: sums over a conversation's later blocks are running sums, added up per distinct block and, inside it, per
turn. So the work is linear in the number of blocks, whatever the depth, and no subtree, level or path is gathered.

Skew: running values of a long conversation are found in segments of ``SEGMENT`` blocks and joined by (conversation,
segment), so one conversation may hold a third of all turns; a first turn or a whole conversation that a third of all
share is pre-aggregated before the shuffle. Texts are read once and leave as digests.

Turns are ordered by their number, null first, then by digest, so that repeated numbers have a defined order. Null
roles and texts are empty. Rows without a conversation id belong to no conversation. Extra columns are ignored; an
empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgrid.operators.joins import many_to_one_join
from trustgrid.operators.ranking import places

from .common import CRC_TABLE, crc32_sql, saved, width

BLOCK = 4
SEGMENT = 4096
ENDS = 1 << 16              # ids joined to one text
NODE = ["depth", "i1", "i2"]


def before(rows: DataFrame, key: str, at: str, total: Callable[[Column], Column], join: Callable[[Column, Column], Column],
           values: dict[str, Column], after: bool = False) -> DataFrame:
    """``rows`` with, per name, the ``total`` of a value over the rows of the same key before (or after) the row by ``at``.

    Places are cut into segments of ``SEGMENT``: totals of segments are summed up first, then rows inside segments.
    """
    work = rows.withColumn("__seg", F.floor(F.col(at) / SEGMENT)).withColumns(
        {f"__v{i}": v for i, v in enumerate(values.values())})

    def window(keys: list[str], order: str):
        by = Window.partitionBy(*keys).orderBy(F.desc(order) if after else F.asc(order))
        return by.rowsBetween(Window.unboundedPreceding, -1)

    per = work.groupBy(key, "__seg").agg(*[total(F.col(f"__v{i}")).alias(f"__s{i}") for i in range(len(values))])
    sums = per.select(F.col(key).alias("__k"), F.col("__seg").alias("__g"), *[
        F.coalesce(total(F.col(f"__s{i}")).over(window([key], "__seg")), F.lit(0)).alias(f"__s{i}") for i in range(len(values))])
    near = work.withColumns({f"__w{i}": F.coalesce(total(F.col(f"__v{i}")).over(window([key, "__seg"], at)), F.lit(0))
                             for i in range(len(values))})
    joined = near.join(sums, (F.col(key) == F.col("__k")) & (F.col("__seg") == F.col("__g")))
    return joined.select(*rows.columns, *[join(F.col(f"__s{i}"), F.col(f"__w{i}")).alias(name) for i, name in enumerate(values)])


def xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def block_rows(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: the prefix's digest before it, its own, its turns in order.

    ``turns`` is (conv, pos, n, digest, chars) with pos from 0 and n the conversation's number of turns.
    """
    hashed = turns.select("conv", F.floor(F.col("pos") / BLOCK).alias("k"), "n", F.struct(
        "pos", F.xxhash64("pos", "digest").alias("v1"), F.xxhash64("digest", F.lit(1), "pos").alias("v2"), "chars").alias("turn"))
    blocks = hashed.groupBy("conv", "k").agg(
        F.max("n").alias("n"), F.bit_xor("turn.v1").alias("x1"), F.bit_xor("turn.v2").alias("x2"),
        F.array_sort(F.collect_list("turn")).alias("turns"))
    return before(blocks, "conv", "k", F.bit_xor, xor, {"p1": F.col("x1"), "p2": F.col("x2")})


BLOCK_KEY = ["k", "p1", "p2", "x1", "x2", "len"]


def distinct_blocks(rows: DataFrame) -> DataFrame:
    """One row per prefix and block that follows it: members, the smallest one, its turns, and whether no other block
    follows the prefix (``chain``)."""
    found = saved(rows.withColumn("len", F.size("turns")).groupBy(*BLOCK_KEY).agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("turns").alias("turns")), "blocks")
    alone = found.groupBy("k", "p1", "p2").agg(F.count("*").alias("follow"), F.min("conv").alias("conv")) \
        .filter("follow = 1").select("k", "conv", F.lit(True).alias("chain"))
    return found.join(alone, ["k", "conv"], "left").withColumn("chain", F.coalesce("chain", F.lit(False)))


def turn_rows(blocks: DataFrame) -> DataFrame:
    """Blocks spread into turns: the node (depth, i1, i2) each turn leads to and its parent (up1, up2)."""
    def ids(first: str, value: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size("turns")), lambda i: F.aggregate(
            F.slice("turns", F.lit(1), i), F.col(first), lambda a, t: xor(a, t[value])))

    spread = blocks.withColumns({"__1": ids("p1", "v1"), "__2": ids("p2", "v2")}) \
        .select(*BLOCK_KEY, "conv", "n", "chain", "__1", "__2", F.posexplode("turns").alias("t", "turn"))
    return spread.select(
        *BLOCK_KEY, "conv", "n", "chain", "t", (F.col("k") * BLOCK + F.col("t") + 1).alias("depth"),
        F.col("__1")[F.col("t") + 1].alias("i1"), F.col("__2")[F.col("t") + 1].alias("i2"),
        F.col("__1")[F.col("t")].alias("up1"), F.col("__2")[F.col("t")].alias("up2"), F.col("turn.chars").alias("chars"))


def prefix_trie(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of all conversations in ``members`` (conv); their turns are (conv, pos, n, digest, chars).

    nodes: depth, i1, i2 (the prefix's digest), up1, up2 (the parent's), conv (smallest member), n (members), children,
    leaves (childless nodes in the subtree), saved (over the subtree, (members - 1) x characters of the last turn).
    ends: the node at which each conversation ends.
    """
    rows = saved(block_rows(turns), "rows")
    blocks = saved(distinct_blocks(rows), "distinct")
    steps = saved(turn_rows(blocks), "turns")
    node = [*NODE, "up1", "up2", "k"]
    chained = steps.filter("chain").select(*node, "conv", "n", "chars")
    refined = steps.filter("not chain").groupBy(*node).agg(F.min("conv").alias("conv"), F.sum("n").alias("n"), F.first("chars").alias("chars"))
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).filter("n > 0").select(
        zero.alias("depth"), zero.alias("i1"), zero.alias("i2"), F.lit(None).cast("long").alias("up1"),
        F.lit(None).cast("long").alias("up2"), F.lit(-1).cast("long").alias("k"), "conv", "n", F.lit(0).alias("chars"))
    below = chained.unionByName(refined)
    children = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("i1"), F.col("up2").alias("i2")) \
        .agg(F.count("*").alias("children"))
    nodes = saved(below.unionByName(root).join(children, NODE, "left").withColumn("children", F.coalesce("children", F.lit(0)))
                  .withColumns({"own": (F.col("n") - 1) * F.col("chars"), "leaf": (F.col("children") == 0).cast("long")}), "nodes")

    # what nodes add to nodes above: along the blocks of their smallest member ...
    owned = nodes.filter("depth > 0").groupBy("conv", "k").agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf"))
    path = rows.withColumn("len", F.size("turns")).select("conv", *BLOCK_KEY).join(owned, ["conv", "k"], "left")
    later = before(path, "conv", "k", F.sum, lambda a, b: a + b,
                   {"below_own": F.coalesce("own", F.lit(0)), "below_leaf": F.coalesce("leaf", F.lit(0))}, after=True)
    deeper = later.groupBy(*BLOCK_KEY).agg(F.sum("below_own").alias("below_own"), F.sum("below_leaf").alias("below_leaf"))
    # ... and along the turns of its block
    mine = nodes.filter("depth > 0").select("depth", "conv", "own", "leaf")
    inside = Window.partitionBy("k", "conv").orderBy(F.desc("t"))
    sums = {c: F.sum(F.coalesce(c, F.lit(0))).over(inside) + F.col(f"below_{c}") for c in ("own", "leaf")}
    adds = steps.join(mine, ["depth", "conv"], "left").join(deeper, BLOCK_KEY) \
        .select(*NODE, "chain", sums["own"].alias("saved"), sums["leaf"].alias("leaves"))
    added = adds.filter("chain").drop("chain").unionByName(
        adds.filter("not chain").groupBy(*NODE).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")))
    whole = nodes.agg(F.sum("own").alias("saved"), F.sum("leaf").alias("leaves")).filter("leaves is not null").select(
        *[zero.alias(c) for c in NODE], "saved", "leaves")
    out = nodes.join(added.unionByName(whole), NODE).select(*NODE, "up1", "up2", "conv", "n", "children", "leaves", "saved")

    last = rows.filter(F.col("k") == F.floor((F.col("n") - 1) / BLOCK)).select(
        "conv", F.col("n").alias("depth"), xor(F.col("p1"), F.col("x1")).alias("i1"), xor(F.col("p2"), F.col("x2")).alias("i2"))
    none = members.select("conv").join(last.select("conv"), "conv", "left_anti").select("conv", *[zero.alias(c) for c in NODE])
    return out, last.unionByName(none)


def joined_digest(ends: DataFrame) -> DataFrame:
    """Per node the SHA-256 of its ids, ascending and comma-joined: ids are joined in pieces of ``ENDS``, and the pieces
    of a node are hashed one after the other, so a task holds one piece at a time."""
    cut = places(ends, ["conv"], NODE, size=None).withColumn("piece", F.floor(F.col("pos") / ENDS))
    pieces = cut.groupBy(*NODE, "piece").agg(F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield rows_of(done)
        if node is not None:
            yield rows_of([(*node, state.hexdigest())])

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) or [[]] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                                          names=[*NODE, "ends_sha256"])

    dealt = pieces.repartition(width(ends.sparkSession), *NODE).sortWithinPartitions(*NODE, "piece")
    return dealt.select(*NODE, "ids").mapInArrow(run, "depth long, i1 long, i2 long, ends_sha256 string")


HEADS, FAMILY = 6, 100


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, members): every conversation c with the first h turns of its family's first one (c - c % 100) in place of its
    own first h, where h is crc32(c as text) % 6."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("digest"),
        F.length(text).alias("chars"))
    own = saved(places(rows, ["turn", "digest"], ["conv"], pos="own", size=None), "own")
    members = own.filter("own = 0").select("conv")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    heads = own.filter((F.col("conv") % FAMILY == 0) & (F.col("own") < HEADS - 1)).groupBy(F.col("conv").alias("first")).agg(
        F.array_sort(F.collect_list(F.struct("own", "digest", "chars"))).alias("head"))
    taken = members.withColumn("first", F.col("conv") - F.col("conv") % FAMILY).join(heads, "first") \
        .select("conv", F.explode(F.slice("head", F.lit(1), h)).alias("t")).select("conv", F.lit(0).alias("part"), "t.*")
    kept = own.filter(F.col("own") >= h).select("conv", F.lit(1).alias("part"), "own", "digest", "chars")
    return places(taken.unionByName(kept), ["part", "own"], ["conv"]).select("conv", "pos", "n", "digest", "chars"), members


def op13_prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node."""
    turns, members = rebuilt_turns(conversations)
    members = saved(members, "members")
    nodes, ends = prefix_trie(turns, members)
    nodes, ends = saved(nodes, "trie"), saved(ends, "ends")
    parents = nodes.filter("children > 0").select(F.col("depth").alias("pd"), F.col("i1").alias("p1"), F.col("i2").alias("p2"),
                                                  F.col("conv").alias("parent_conv_id"))
    # a node may have very many children
    below = many_to_one_join(nodes.withColumn("above", F.col("depth") - 1), parents, ["above", "up1", "up2"], ["pd", "p1", "p2"])
    out = below.join(joined_digest(ends), NODE, "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
                      F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def op13_sql() -> str:
    """DuckDB form: every prefix as a list of its turns' digests."""
    return f"""
WITH crc AS ({CRC_TABLE}),
rows AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
members AS (SELECT c, {crc32_sql("CAST(c AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT c FROM rows), crc),
rebuilt AS (SELECT m.c, 0 AS part, r.i, r.d, r.chars FROM members m JOIN rows r ON r.c = m.c - m.c % 100 AND r.i <= m.h
  UNION ALL SELECT m.c, 1, r.i, r.d, r.chars FROM members m JOIN rows r ON r.c = m.c AND r.i > m.h),
whole AS (SELECT m.c, coalesce(list(r.d ORDER BY part, i) FILTER (WHERE r.d IS NOT NULL), []) AS ds,
    coalesce(list(r.chars ORDER BY part, i) FILTER (WHERE r.d IS NOT NULL), []) AS cs FROM members m LEFT JOIN rebuilt r ON r.c = m.c GROUP BY m.c),
path AS (SELECT c, len(ds) AS size, d AS depth, md5(array_to_string(ds[1:d], ',')) AS node,
    CASE WHEN d > 0 THEN md5(array_to_string(ds[1:d - 1], ',')) END AS up, coalesce(cs[d], 0) AS chars
  FROM (SELECT *, unnest(range(0, len(ds) + 1)) AS d FROM whole)),
nodes AS (SELECT depth, node, any_value(up) AS up, min(c) AS c, count(*) AS n, any_value(chars) AS chars FROM path GROUP BY depth, node),
counted AS (SELECT p.*, coalesce(k.n_children, 0) AS n_children FROM nodes p LEFT JOIN (
  SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY depth, up) k USING (depth, node)),
sums AS (SELECT a.depth, a.node, sum((v.n - 1) * v.chars) AS saved, count(*) FILTER (WHERE v.n_children = 0) AS leaves
  FROM counted v JOIN path a ON a.c = v.c AND a.depth <= v.depth GROUP BY a.depth, a.node),
ends AS (SELECT depth, node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM path WHERE depth = size GROUP BY depth, node)
SELECT CAST(x.c AS BIGINT) AS conv_id, CAST(x.depth AS BIGINT) AS depth, CAST(u.c AS BIGINT) AS parent_conv_id,
  CAST(x.n AS BIGINT) AS n_convs, CAST(x.n_children AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted x JOIN sums s USING (depth, node) LEFT JOIN nodes u ON u.depth = x.depth - 1 AND u.node = x.up
LEFT JOIN ends e ON e.depth = x.depth AND e.node = x.node
"""
