"""A Merkle manifest of a table, and proofs of its rows, by the preimages of parents.

A leaf is the hash of a row's fields. Within a group (a source) leaves stand in order; every 16 neighbours become a parent,
level by level, until one node is left: the group's subroot. The subroots, in order of the groups, become the root likewise.
The manifest stores of each parent not links to its children but its *preimage*: the children's hashes, end to end.

A row's proof needs no table of siblings: the row joins the preimages on its way to the root. In each, the 64 characters at the
row's own slot are the hash from below; what is left without them are the siblings, and with another hash spliced in there the
preimage of a changed row's parent comes out, so a proof is folded by one hash a level.

Ranks are found without a task for a whole group: rows are sorted by range over all tasks, counted by task and group, and numbered
from the counts before them. Parents are keyed by group and place, so a group with most of the rows is spread like any other. A parent
first gathers the preimages above it, so each of the 16 times fewer parents goes to its leaves once, with its whole path.

Nulls are fields of their own (``-``); empty texts have a length of 0. Rows that are equal in all fields are leaves each, side by side;
rows of one id are ordered by their hashes. Groups come in order of their UTF-8 bytes, null first. An empty table has no rows and
no root. Other columns of the table are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.common import dropped, stored

FAN, DIGITS = 16, 64
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PATH = "array<struct<preimage:string,slot:bigint>>"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _CAPITALS, _CAPITALS.lower())


def field(value: Column) -> Column:
    """A field as it goes into a leaf: its length in bytes, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """Adds ``pos``, the place of each row within its group ``g`` in the order given, and ``n``, the rows of the group; stored."""
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = nodes.repartitionByRange("g", *order).sortWithinPartitions("g", *order).select("*", F.spark_partition_id().alias("part"), at.alias("at"))
    placed = stored(placed, "ranks")
    parts = placed.groupBy("g", "part").agg(F.count("*").alias("held"), F.min("at").alias("low"))
    group = Window.partitionBy("g")
    before = F.coalesce(F.sum("held").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("g", "part", (before - F.col("low")).alias("shift"), F.sum("held").over(group).alias("n"))
    made = stored(placed.join(parts, ["g", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift"), "leaves")
    dropped(placed)
    return made


@dataclass
class Tree:
    """Leaves (g, pos, n, hash and what came along) and, by level, parents (g, pos, n, preimage, hash); n: nodes of the level."""

    leaves: DataFrame
    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """g and the hash of the last node of each group."""
        found = self.leaves.where("n = 1").select("g", "hash")
        for level in self.levels:
            found = found.union(level.where("n = 1").select("g", "hash"))
        return found


def tree(leaves: DataFrame) -> Tree:
    """Parents of ranked leaves, level by level; each level is stored, and is a sixteenth of the one below."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, levels = leaves, []
    while most > 1:
        children = F.array_sort(F.collect_list(F.struct("pos", "hash")))
        grouped = nodes.where("n > 1").groupBy("g", F.expr(f"pos div {FAN}").alias("up"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n_up"))
        made = grouped.agg(F.array_join(F.transform(children, lambda c: c.hash), "").alias("preimage"))
        nodes = stored(made.select("g", F.col("up").alias("pos"), F.col("n_up").alias("n"), "preimage", F.sha2("preimage", 256).alias("hash")), "parents")
        levels.append(nodes)
        most = -(-most // FAN)
    return Tree(leaves, levels)


def _climbed(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """Nodes with what their parents hold: the parent's preimage and this node's slot come before the parent's own path."""
    held = parents.select("g", F.col("pos").alias("up"), F.col("preimage").alias("_preimage"), *[F.col(c).alias(f"_{c}") for c in ("path", "subroot")])
    joined = nodes.where("n > 1").withColumn("up", F.expr(f"pos div {FAN}")).join(held, ["g", "up"])
    step = F.struct(F.col("_preimage").alias("preimage"), (F.col("pos") % FAN).alias("slot"))
    return joined.withColumn("path", F.concat(F.array(step), F.col("_path"))).withColumn("subroot", F.col("_subroot")).drop("up", "_preimage", "_path", "_subroot")


def with_paths(held: Tree, at_top: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The leaves with ``path``, the preimages up to the root with the slot below in each, and ``subroot``. ``at_top`` adds both to
    the last node of each group."""
    above = None
    for nodes in [*reversed(held.levels), held.leaves]:
        own = at_top(nodes.where("n = 1"))
        above = own if above is None else own.unionByName(_climbed(nodes, above))
    return above


def siblings(path: Column) -> Column:
    """The hashes beside each slot, from the leaf up and left to right, end to end."""
    before, after = (lambda x: F.substring(x.preimage, F.lit(1), (DIGITS * x.slot).cast("int"))), (lambda x: F.substr(x.preimage, (DIGITS * (x.slot + 1) + 1).cast("int")))
    return F.array_join(F.transform(path, lambda x: F.concat(before(x), after(x))), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf: its hash goes into its slot of the first preimage, that one's hash into the next."""

    def up(below: Column, x: Column) -> Column:
        before, after = F.substring(x.preimage, F.lit(1), (DIGITS * x.slot).cast("int")), F.substr(x.preimage, (DIGITS * (x.slot + 1) + 1).cast("int"))
        return F.sha2(F.concat(before, below, after), 256)

    return F.aggregate(path, leaf, up)


@dataclass
class Manifest:
    """The trees of all groups and the one above them; root: of the whole table, None if it is empty."""

    groups: Tree
    top: Tree
    root: str | None

    def proofs(self) -> DataFrame:
        """The leaves, with whatever came along, and ``path``, ``subroot`` and ``root``."""
        sources = with_paths(self.top, lambda last: last.withColumn("path", F.array().cast(_PATH)).withColumn("subroot", F.lit("")))
        sources = sources.select(F.col("group").alias("g"), "path", F.col("hash").alias("subroot"))
        return with_paths(self.groups, lambda last: last.join(sources, "g")).withColumn("root", F.lit(self.root))


def manifest(rows: DataFrame, group: Column, order: str, leaf: str) -> Manifest:
    """Manifest of rows; ``leaf`` names the column of their hashes, ``order`` what they ascend by. Other columns come along."""
    keyed = rows.withColumn("g", F.coalesce(F.concat(F.lit("="), group), F.lit(""))).withColumnRenamed(leaf, "hash")  # null comes first
    groups = tree(ranked(keyed, order, "hash"))
    tops = groups.tops().select(F.lit("").alias("g"), F.col("g").alias("group"), "hash")
    top = tree(ranked(tops, "group"))
    last = top.tops().first()
    return Manifest(groups, top, last and last.hash)


def verify(df: DataFrame, fields: list[str], group: str, changed: Column, text: str = "text") -> DataFrame:
    """Of each row: its first field, leaf, subroot, root, the siblings of its proof (``proof_sha256`` is their hash), and
    ``folded_root``, to which its proof leads from the row as presented: where ``changed``, with its text in lower case.

    ``fields`` go into the leaf in order; the first is the id, by which a group's leaves ascend.
    """
    names = [f"f{i}" for i in range(len(fields))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(fields, names)], F.col(group).cast("string").alias("own_group"), F.coalesce(changed, F.lit(False)).alias("changed"))
    presented = [lower_ascii(F.col(n)) if c == text else F.col(n) for c, n in zip(fields, names)]
    rows = rows.select(F.col("f0").alias("id"), "own_group", leaf_hash(*map(F.col, names)).alias("leaf"), F.when(F.col("changed"), leaf_hash(*presented)).alias("presented"))
    found = manifest(rows, F.col("own_group"), "id", "leaf").proofs()
    root = folded(F.coalesce("presented", "hash"), F.col("path"))
    made = found.select(F.col("id").alias(fields[0]), F.col("hash").alias("leaf"), "subroot", "root", siblings(F.col("path")).alias("siblings"), root.alias("folded_root"))
    return made.withColumn("proof_sha256", F.sha2("siblings", 256)).withColumn("verified", F.col("folded_root") == F.col("root"))
