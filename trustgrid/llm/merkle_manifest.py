"""Merkle manifest of a dataset with incremental witnesses.

Every row is a leaf; leaves of a group (a source) ascend by id. While a level has several nodes, each ``FAN`` consecutive
ones (the last run may be shorter, even one) become the hash of their concatenated hex digests. What remains is the
group's subroot; subroots in order of their groups give the root the same way. A leaf's witness holds its siblings,
level by level from its run up to the root.

Witnesses grow by appending. A block is an aligned range of ``FAN ** height`` leaves. Its leaves are appended one by one
to an ``Appender``: a node joins the open run of its level, and when the run's last sibling arrives the run closes, its
nodes get their siblings as the next part of their witness, and their parent is appended one level up, where later
siblings extend the witness of the whole subtree once for all its leaves. The roots of the blocks, made in parallel,
are appends to the next round of blocks, and so on to the root; the parts of the witness that an upper round finds are
handed down to the blocks below.

Texts are read once, for the leaves, and never shuffled; digests are. A group of any size is a row of blocks, and a task
holds one block (``FAN ** height`` digests) at a time. Places of leaves come from range partitions. The driver sees the
largest number of nodes per round only.

Null groups form a group of their own, before all others. Rows with equal ids are ordered by their digests; equal rows
are leaves of their own. Null fields count as ``-``, an empty text as ``0:``. An empty table has no rows and no root.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustgrid.operators.ranking import places

from .common import CRC_TABLE, crc32_sql, saved

FAN = 16
HEIGHT = 3              # levels that a block climbs: 4,096 leaves
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def levels_of(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


class Subtree:
    """A node with the witness found so far: the siblings of its run, and its parent, which holds what follows."""

    __slots__ = ("digest", "siblings", "step", "up", "tail")

    def __init__(self, digest: bytes):
        self.digest = digest
        self.up: Subtree | None = None
        self.tail: tuple[bytes, list[int]] | None = None

    def extend(self, place: int, run: bytes, up: Subtree) -> None:
        self.siblings = run[:32 * place] + run[32 * place + 32:]
        self.step, self.up = len(run) // 32 * FAN + place, up

    def witness(self) -> tuple[bytes, list[int]]:
        """(siblings level by level, steps); what lies above is found once per subtree."""
        if self.tail is None:
            if self.up is None:
                self.tail = (b"", [])
            else:
                above, steps = self.up.witness()
                self.tail = (self.siblings + above, [self.step, *steps])
        return self.tail


class Appender:
    """Aligned append of digests to a tree of ``height`` levels; only the open run of each level waits."""

    def __init__(self, height: int):
        self.open: list[list[Subtree]] = [[] for _ in range(height)]
        self.root: Subtree | None = None

    def append(self, digest: bytes) -> Subtree:
        node = Subtree(digest)
        self._add(node, 0)
        return node

    def _add(self, node: Subtree, level: int) -> None:
        if level == len(self.open):
            self.root = node
            return
        self.open[level].append(node)
        if len(self.open[level]) == FAN:
            self._close(level)

    def _close(self, level: int) -> None:
        nodes, self.open[level] = self.open[level], []
        run = b"".join(x.digest for x in nodes)
        up = Subtree(hashlib.sha256(run.hex().encode()).digest())
        for place, node in enumerate(nodes):
            node.extend(place, run, up)
        self._add(up, level + 1)

    def finish(self) -> Subtree:
        """Close the runs that are still open, lowest first; the block's root."""
        for level, run in enumerate(self.open):
            if run:
                self._close(level)
        return self.root


def _appended(rows: pa.Table, height: int) -> tuple[pa.Table, list[Subtree], Appender]:
    """The rows of one block in order, appended."""
    rows = rows.take(pc.sort_indices(rows.column("pos")))
    tree = Appender(min(height, levels_of(rows.column("n")[0].as_py())))
    return rows, [tree.append(bytes.fromhex(x)) for x in rows.column("digest").to_pylist()], tree


def close_blocks(nodes: DataFrame, height: int) -> DataFrame:
    """(grp, pos, n, digest) of the blocks' roots: the nodes of the next round."""
    size = FAN ** height

    def run(rows: pa.Table) -> pa.Table:
        rows, _, tree = _appended(rows.combine_chunks(), height)
        first, n = rows.column("pos")[0].as_py(), rows.column("n")[0].as_py()
        return pa.table({"grp": pa.array([rows.column("grp")[0].as_py()], pa.string()),
                         "pos": pa.array([first // size], pa.int64()), "n": pa.array([-(-n // size)], pa.int64()),
                         "digest": pa.array([tree.finish().digest.hex()], pa.string())})

    work = nodes.select("grp", "pos", "n", "digest", F.floor(F.col("pos") / size).alias("block"))
    return work.groupBy("grp", "block").applyInArrow(run, "grp string, pos long, n long, digest string")


def open_blocks(nodes: DataFrame, above: DataFrame, carry: Sequence[str], height: int) -> DataFrame:
    """``nodes`` with the columns ``carry`` of ``above`` and the whole witness and steps of each node.

    ``above`` has one row per block: (grp, pos) of its root in the round above, with that root's witness and steps.
    """
    size = FAN ** height
    left = nodes.withColumn("block", F.floor(F.col("pos") / size))
    right = above.select("grp", F.col("pos").alias("block"), "witness", "steps", *carry)
    schema = T.StructType([*nodes.schema.fields, *[above.schema[c] for c in carry],
                           T.StructField("witness", T.BinaryType()), T.StructField("steps", T.ArrayType(T.IntegerType()))])
    names = nodes.columns

    def run(rows: pa.Table, up: pa.Table) -> pa.Table:
        rows, leaves, tree = _appended(rows.combine_chunks(), height)
        tree.finish().tail = (up.column("witness")[0].as_py(), up.column("steps")[0].as_py())
        found = [x.witness() for x in leaves]
        out = {c: rows.column(c) for c in names}
        out |= {c: pa.array([up.column(c)[0].as_py()] * len(leaves), up.column(c).type) for c in carry}
        out["witness"] = pa.array([w for w, _ in found], pa.binary())
        out["steps"] = pa.array([s for _, s in found], pa.list_(pa.int32()))
        return pa.table(out)

    return left.groupBy("grp", "block").cogroup(right.groupBy("grp", "block")).applyInArrow(run, schema)


def climb(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The rounds of blocks: ``nodes``, the roots of their blocks, and so on until every group has one node."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rounds.append(saved(close_blocks(rounds[-1], height), "blocks"))
    return rounds


def _tops(nodes: DataFrame) -> DataFrame:
    return nodes.withColumns({"witness": F.lit(b""), "steps": F.array().cast("array<int>")})


def merkle_witnesses(leaves: DataFrame, order: Sequence[str], group: str = "grp", height: int = HEIGHT) -> DataFrame:
    """``leaves`` (a text column ``digest``, a non-null text column ``group``) with subroot, root, witness and steps.

    ``witness`` is the leaf's siblings as bytes, 32 each, level by level and left to right; ``steps`` says for each
    level how many nodes the run has (times 16) and the place of the own node in it (plus 0 to 15). Groups are ordered
    as texts, leaves in a group by ``order``. All columns of ``leaves`` pass through.
    """
    named = leaves.withColumnRenamed(group, "grp") if group != "grp" else leaves
    rounds = climb(saved(places(named, order, ["grp"]), "leaves"), height)
    subroots = rounds[-1].select(F.lit("").alias("grp"), F.col("grp").alias("source"), "digest")
    forest = climb(saved(places(subroots, ["source"], ["grp"]), "subroots"), height)
    above = _tops(forest[-1].withColumn("root", F.col("digest")))
    for nodes in reversed(forest[:-1]):
        above = saved(open_blocks(nodes, above, ["root"], height), "witnesses")
    above = above.select(F.col("source").alias("grp"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"),
                         "root", "witness", "steps")
    if len(rounds) == 1:                        # no group has a second leaf
        out = rounds[0].join(above.drop("pos"), "grp")
    for k, nodes in enumerate(reversed(rounds[:-1])):
        out = open_blocks(nodes, above, ["subroot", "root"], height)
        above = out if k == len(rounds) - 2 else saved(out, "witnesses")
    keep = [c for c in out.columns if c not in ("pos", "n")]
    return out.select(*keep).withColumnRenamed("grp", group)


def field_text(col: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, a colon and the value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]).cast("binary"), 256)


def group_key(col: Column) -> Column:
    """A text that orders null first and values bytewise."""
    return F.when(col.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), col.cast("string")))


def witness_digest(witness: Column) -> Column:
    """Hash of the siblings' hex digests, as they stand in the witness."""
    return F.sha2(F.lower(F.hex(witness)).cast("binary"), 256)


def fold(leaf: Column, witness: Column, steps: Column) -> Column:
    """The root that a leaf digest and a witness lead to."""
    def part(start: Column, length: Column) -> Column:
        return F.lower(F.hex(F.substring(witness, start + 1, length)))

    def step(state: Column, code: Column) -> Column:
        before = F.pmod(code, F.lit(FAN)) * 32
        others = (F.shiftright(code, 4) - 1) * 32
        run = F.concat(part(state["at"], before), state["digest"], part(state["at"] + before, others - before))
        return F.struct(F.sha2(run.cast("binary"), 256).alias("digest"), (state["at"] + others).alias("at"))

    return F.aggregate(steps, F.struct(leaf.alias("digest"), F.lit(0).alias("at")), step, lambda s: s["digest"])


def op11_merkle_manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root that its text, tampered with in part, leads to."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select("doc_id", group_key(F.col("source")).alias("grp"), leaf_digest(*fields, text).alias("digest"),
                         F.when(hit, leaf_digest(*fields, F.translate(text, UPPER, LOWER))).alias("tampered"))
    out = merkle_witnesses(saved(leaves, "digests"), ["doc_id", "digest"], height=height)
    shown = F.coalesce("tampered", "digest")
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", witness_digest(F.col("witness")).alias("proof_sha256"),
                      fold(shown, F.col("witness"), F.col("steps")).alias("folded_root")
                      ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_sql(levels: int = 6, source_levels: int = 4) -> str:
    """DuckDB form, unrolled: up to ``16 ** levels`` documents a source and ``16 ** source_levels`` sources."""
    def field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    ctes = [f"crc AS ({CRC_TABLE})", f"""docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS grp, sha256({head} || {field('text')}) AS leaf,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0
      THEN sha256({head} || {field(f"translate(text, '{UPPER}', '{LOWER}')")}) END AS tampered FROM documents, crc)""",
            """n0 AS (SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h,
    count(*) OVER (PARTITION BY grp) AS n FROM docs)""",
            """p0 AS (SELECT doc_id, leaf, coalesce(tampered, leaf) AS folded, '' AS proof, grp,
    row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs)"""]
    before, after = "substr(cat, 1, (p.pos % 16) * 64)", "substr(cat, (p.pos % 16) * 64 + 65)"

    def level(k: int) -> None:
        ctes.append(f"r{k} AS (SELECT grp, pos // 16 AS run, string_agg(h, '' ORDER BY pos) AS cat, max(n) AS n FROM n{k} "
                    "WHERE n > 1 GROUP BY grp, pos // 16)")
        ctes.append(f"n{k + 1} AS (SELECT grp, run AS pos, sha256(cat) AS h, (n + 15) // 16 AS n FROM r{k} "
                    f"UNION ALL SELECT * FROM n{k} WHERE n = 1)")
        ctes.append(f"p{k + 1} AS (SELECT p.* REPLACE (p.pos // 16 AS pos, CASE WHEN cat IS NULL THEN folded ELSE "
                    f"sha256({before} || folded || {after}) END AS folded, proof || coalesce({before} || {after}, '') AS proof) "
                    f"FROM p{k} p LEFT JOIN r{k} r ON p.grp = r.grp AND p.pos // 16 = r.run)")

    for k in range(levels):
        level(k)
    k = levels + 1
    ctes.append(f"n{k} AS (SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, h, count(*) OVER () AS n, grp AS source "
                f"FROM n{levels})")
    ctes.append(f"p{k} AS (SELECT p.* REPLACE ('' AS grp, s.pos AS pos), s.h AS subroot FROM p{levels} p JOIN n{k} s ON p.grp = s.source)")
    ctes.append(f"n{k + 1} AS (SELECT grp, pos, h, n FROM n{k})")
    ctes.append(f"p{k + 1} AS (SELECT * FROM p{k})")
    for j in range(k + 1, k + 1 + source_levels):
        level(j)
    last = k + 1 + source_levels
    return ("WITH " + ",\n".join(ctes) + "\nSELECT doc_id, leaf, subroot, n.h AS root, sha256(proof) AS proof_sha256, "
            f"folded AS folded_root, folded = n.h AS verified FROM p{last} p, n{last} n")
