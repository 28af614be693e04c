"""A Merkle manifest of a table: leaves, roots and a proof for every row.

Rows are leaves, in order within their group; runs of consecutive nodes become one
node of the next level until one is left, and the roots of the groups are the
leaves of a last tree. Sibling and child digests come from lag and lead columns
at fixed offsets: the nodes of level ``l`` stand on the rows whose place is a
multiple of ``fan_out ** l``, so a sibling is that many rows away, masked by the
node's slot in its run and by the length of the run.

A window covers one chunk of aligned places, never a group, so a large group is
many tasks. The roots of chunks are the rows of the next tier.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilmark.llm.common import one_row, stored

CHUNK = 256
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_ONE_IN = 7


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    whole = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(whole, F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return digest(*[encoded(f) for f in fields])


def ranked(leaves: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Leaves with ``pos``, their place in the group from 0, and ``n``, its size.

    The rows are range-partitioned by group, order and a number of their own, so
    neither a hot group nor repeated rows stay in one task, and stored, so that the
    parts stay as they are. Sizes of parts give the places before each.
    """
    sort = [group, *order, "_tie"]
    laid = leaves.withColumn("_tie", F.monotonically_increasing_id())
    laid = laid.repartitionByRange(*sort).withColumn("_part", F.spark_partition_id())
    laid = stored(laid, "manifest-leaves")
    sizes = laid.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(
        F.count("*").alias("_n")
    )
    # Few rows: a part holds one group or the last and first rows of several.
    of_group = Window.partitionBy("_g")
    before = of_group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_g",
        "_p",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.sum("_n").over(of_group).alias("n"),
    )
    on = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p"))
    inside = Window.partitionBy("_part", group).orderBy(*order, "_tie")
    return laid.join(offsets, on).select(
        *leaves.columns, (F.row_number().over(inside) - 1 + F.col("_n0")).alias("pos"), "n"
    )


def _levels(fan_out: int) -> int:
    """Levels of a tier: as many as fit a chunk."""
    levels = 1
    while fan_out ** (levels + 1) <= CHUNK:
        levels += 1
    return levels


def climbed(nodes: DataFrame, group: str, fan_out: int) -> DataFrame:
    """The levels of one tier, bottom up: ``step_0``, ``step_1`` ... and the roots.

    ``nodes`` has the group, ``pos``, ``n`` (nodes of the group) and ``hash``. A step is
    what stands to the left and right of a row's node in its run, NULL where the
    row does not stand for a node of that level or the level has one node only.
    Afterwards ``hash`` of the first row of each chunk is the chunk's root.
    """
    levels = _levels(fan_out)
    rows = nodes.withColumn("chunk", F.floor(F.col("pos") / fan_out**levels))
    window = Window.partitionBy(group, "chunk").orderBy("pos")
    for level in range(levels):
        reach = fan_out**level
        count = F.ceil(F.col("n") / reach)
        node = F.floor(F.col("pos") / reach)
        slot = node % fan_out
        run = F.least(F.lit(fan_out), count - (node - slot))
        left = [
            F.when(slot >= o, F.lag("hash", o * reach).over(window))
            for o in range(fan_out - 1, 0, -1)
        ]
        right = [
            F.when(slot + o < run, F.lead("hash", o * reach).over(window))
            for o in range(1, fan_out)
        ]
        stands = (F.col("pos") % reach == 0) & (count > 1)
        step = F.struct(F.concat_ws("", *left).alias("l"), F.concat_ws("", *right).alias("r"))
        rows = rows.withColumn(f"step_{level}", F.when(stands, step))
        parent = digest(F.col("hash"), F.col(f"step_{level}.r"))
        rows = rows.withColumn("hash", F.when(stands & (slot == 0), parent).otherwise(F.col("hash")))
    return rows


def descended(rows: DataFrame, group: str, fan_out: int) -> DataFrame:
    """``path`` of every row of a climbed tier: its steps, from its level upwards.

    From the top down, a first child has its parent's path on its own row and its
    siblings find it at a fixed lag.
    """
    levels = _levels(fan_out)
    window = Window.partitionBy(group, "chunk").orderBy("pos")
    nothing = F.array().cast("array<struct<l:string,r:string>>")
    rows = rows.withColumn("path", F.when(F.col("pos") % fan_out**levels == 0, nothing))
    for level in reversed(range(levels)):
        reach = fan_out**level
        slot = F.floor(F.col("pos") / reach) % fan_out
        above = F.col("path")
        for o in range(1, fan_out):
            above = F.when(slot == o, F.lag("path", o * reach).over(window)).otherwise(above)
        step = F.col(f"step_{level}")
        own = F.when(step.isNull(), nothing).otherwise(F.array(step))
        rows = rows.withColumn("_above", above).withColumn(
            "path", F.when(F.col("pos") % reach == 0, F.concat(own, F.col("_above")))
        )
    return rows.drop("_above", *[f"step_{level}" for level in range(levels)])


def tiers_of(nodes: DataFrame, group: str, fan_out: int) -> list[DataFrame]:
    """The nodes and above them the roots of chunks, until every group has one."""
    size = fan_out ** _levels(fan_out)
    most = one_row(nodes.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most")))["most"]
    tiers = [nodes]
    while most > 1:
        top = climbed(tiers[-1], group, fan_out).where(F.col("pos") % size == 0)
        roots = top.select(
            group,
            F.col("chunk").alias("pos"),
            F.ceil(F.col("n") / size).alias("n"),
            "hash",
        )
        tiers.append(stored(roots, "manifest-tier"))
        most = -(-most // size)
    return tiers


def paths_down(
    tiers: list[DataFrame], group: str, fan_out: int, top: DataFrame
) -> DataFrame:
    """The lowest tier's rows with whole paths; ``top`` has those of the groups' roots.

    ``top`` has the group as ``_g``, ``upper`` (a path) and ``subroot``. A chunk's rows
    join one row of the tier above, by the key they are grouped by already.
    """
    upper = tiers[-1].join(top, F.col(group).eqNullSafe(F.col("_g")))
    upper = upper.select("_g", F.col("pos").alias("_c"), "upper", "subroot")
    for depth in reversed(range(len(tiers) - 1)):
        rows = descended(climbed(tiers[depth], group, fan_out), group, fan_out)
        on = F.col(group).eqNullSafe(F.col("_g")) & (F.col("chunk") == F.col("_c"))
        rows = rows.join(upper, on).withColumn("path", F.concat("path", "upper"))
        if depth == 0:
            return rows
        upper = stored(
            rows.select(
                F.col(group).alias("_g"),
                F.col("pos").alias("_c"),
                F.col("path").alias("upper"),
                "subroot",
            ),
            "manifest-paths",
        )
    # Every group is one leaf.
    return tiers[0].join(top, F.col(group).eqNullSafe(F.col("_g"))).withColumn(
        "path", F.col("upper")
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["l"], node, s["r"]))


def proof_digest(path: Column) -> Column:
    siblings = F.transform(path, lambda s: F.concat(s["l"], s["r"]))
    return F.sha2(F.array_join(siblings, ""), 256)


def manifest(
    rows: DataFrame, group: str, order: Sequence[str], fan_out: int = 2
) -> DataFrame:
    """Rows with a ``leaf`` digest gain ``path``, ``subroot`` and ``root``.

    Within a group leaves ascend by ``order`` (NULL first), ties by their digest. Runs
    of ``fan_out`` nodes, the last one shorter, become a node each until one is left.
    Groups' roots, ordered by group (NULL first), form a last tree in the same way. A
    path lists from the leaf up what stands left and right of the node in its run. No
    row gives no row. The names ``pos``, ``n``, ``chunk``, ``hash``, ``path``, ``upper``,
    ``subroot``, ``root``, ``step_0`` ... and names with a leading underscore are
    taken; `document_manifest` hands over none but its own.
    """
    nodes = ranked(rows, group, [*order, "leaf"])
    nodes = stored(nodes.withColumn("hash", F.col("leaf")), "manifest-ranked")
    tiers = tiers_of(nodes, group, fan_out)
    subroots = tiers[-1].select(F.col(group).alias("_member"), F.col("hash").alias("leaf"))
    # The last tree: one group, whose leaves are the groups.
    last = ranked(subroots.withColumn("_all", F.lit(0)), "_all", ["_member"])
    last = stored(last.withColumn("hash", F.col("leaf")), "manifest-subroots")
    last_tiers = tiers_of(last, "_all", fan_out)
    found = last_tiers[-1].select("hash").first()
    root = F.lit(found["hash"] if found else None).cast("string")
    nothing = F.array().cast("array<struct<l:string,r:string>>")
    top = last_tiers[-1].select(F.col("_all").alias("_g"), nothing.alias("upper"), root.alias("subroot"))
    top = paths_down(last_tiers, "_all", fan_out, top).select(
        F.col("_member").alias("_g"), F.col("path").alias("upper"), F.col("leaf").alias("subroot")
    )
    whole = paths_down(tiers, group, fan_out, stored(top, "manifest-group-paths"))
    return whole.select(*rows.columns, "path", "subroot", root.alias("root"))


def document_manifest(docs: DataFrame, fan_out: int = 2) -> DataFrame:
    """Every document with its proof, and whether a copy with changes still proves.

    The leaf is the digest of `FIELDS`. Where 7 divides the checksum of the id,
    the tampered copy has one more in ``n_chars``; it proves only if that is NULL. Documents
    without an id come first and are never tampered with; rows that repeat an id are
    ordered by their digest and equal rows are leaves of their own. NULL and empty
    text differ. An empty table gives no rows. Other columns are not read.
    """
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    is_tampered = F.coalesce(number % TAMPERED_ONE_IN == 0, F.lit(False))
    changed = {"n_chars": F.col("n_chars") + 1}
    leaves = docs.select(
        "doc_id",
        "lang",
        leaf_digest([F.col(f) for f in FIELDS]).alias("leaf"),
        F.when(is_tampered, leaf_digest([changed.get(f, F.col(f)) for f in FIELDS])).alias("other"),
    )
    rows = manifest(leaves, "lang", ["doc_id"], fan_out)
    rows = rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("other", "leaf"), F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
