"""Joins between members, claims, providers and authorizations.

Where the result is an aggregate, the many side is reduced per key before the
join, so a key that holds a third of all rows shrinks to one row per task.
Row-level joins go through `spread_join`, which cuts hot keys into slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.operators.masking import masked
from veilmark.sources.model import TABLES

ROWS_PER_SLICE = 1_000_000
MOST_HOT_KEYS = 50_000
PROBE_ONE_IN = 1024


def hot_keys(
    df: DataFrame,
    key: str,
    row_id: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    one_in: int = PROBE_ONE_IN,
    most: int = MOST_HOT_KEYS,
) -> DataFrame:
    """Keys with more rows than one task should have: ``hot_key``, ``n_slices``.

    The limit is ``rows_per_slice`` whatever the size of the table, so a key is cut
    because of its rows and not of its share; it rises only where there would be more
    than ``most`` such keys, which bounds the list. The keys steer how rows are laid
    out and never which rows there are, so they are counted over one row in
    ``one_in``, chosen by a hash of ``row_id``: the answer is the same however
    often it is computed, also when a lost executor makes a stage run again. Only
    the key and ``row_id`` columns are read.
    """
    probe = df if one_in == 1 else df.where(F.xxhash64(*row_id) % one_in == 0)
    counts = probe.groupBy(key).agg((F.count("*") * one_in).alias("n_rows"))
    # The sum of the same counts, so that Spark shuffles the probe once for both.
    total = counts.agg(F.sum("n_rows").alias("n_total")).scalar()
    limit = F.greatest(F.lit(rows_per_slice), F.ceil(total / most))
    return counts.where(F.col(key).isNotNull() & (F.col("n_rows") > limit)).select(
        F.col(key).alias("hot_key"), F.ceil(F.col("n_rows") / limit).alias("n_slices")
    )


def sliced(
    many: DataFrame, many_key: str, hot: DataFrame, row_id: Sequence[str], slice_name: str
) -> DataFrame:
    """Rows with the number of their slice: 0, or one of the slices of a hot key.

    Rows without a key match nothing and are spread over all numbers. The list of hot
    keys has a proven bound, so it is broadcast.
    """
    # Never NULL, so joins need not test for it; not the bits the probe has used.
    row_hash = F.xxhash64(F.lit(slice_name), *row_id)
    number = F.when(F.col(many_key).isNull(), row_hash).otherwise(
        F.coalesce(F.pmod(row_hash, F.col("n_slices")), F.lit(0).cast("long"))
    )
    joined = many.join(F.broadcast(hot), F.col(many_key) == F.col("hot_key"), "left")
    return joined.withColumn(slice_name, number).drop("hot_key", "n_slices")


def repeated(one: DataFrame, one_key: str, hot: DataFrame, slice_name: str) -> DataFrame:
    """Rows once per slice of their key."""
    last = F.coalesce(F.col("n_slices"), F.lit(1).cast("long")) - 1
    joined = one.join(F.broadcast(hot), F.col(one_key) == F.col("hot_key"), "left")
    numbers = F.sequence(F.lit(0).cast("long"), last)
    return joined.withColumn(slice_name, F.explode(numbers)).drop("hot_key", "n_slices")


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate: from file sizes, or huge where it knows nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """Up to which estimate Spark broadcasts a side of a join of its own accord."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def spread_join(
    many: DataFrame,
    one: DataFrame,
    many_key: str,
    one_key: str,
    row_id: Sequence[str],
    how: str = "inner",
    **probe: int,
) -> DataFrame:
    """Equi-join (inner or left) that survives hot and NULL keys of ``many``.

    A side that Spark broadcasts by itself is left to it: nothing has to move then.
    Else both sides are shuffled: rows of a key with more than ``rows_per_slice`` rows
    are cut into as many slices as that takes, by a hash of their ``row_id`` columns, and
    the matching rows of ``one`` are repeated per slice. In a left join the
    rows with a NULL key, which match nothing, are spread the same way. All other keys
    join on slice 0. Column names must not occur on both sides. If ``one`` has
    several rows per key, rows multiply as in any join.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if estimated_bytes(one) <= broadcast_limit(one):
        return many.join(one, F.col(many_key) == F.col(one_key), how)
    hot = hot_keys(many, many_key, row_id, **probe)
    left = sliced(many, many_key, hot, row_id, "join_slice")
    right = repeated(one, one_key, hot, "one_slice")
    on = (F.col(many_key) == F.col(one_key)) & (F.col("join_slice") == F.col("one_slice"))
    return left.join(right, on, how).drop("join_slice", "one_slice")


def deid_join(
    left: DataFrame,
    left_table: str,
    right: DataFrame,
    right_table: str,
    tier: str,
    salt: str,
    on: str = "member_id",
    many_to_many: bool = False,
) -> DataFrame:
    """Row-level join of two tables on an identifier, masked for a tier.

    The right table should have one row per identifier, that is, ``on`` should be its
    key; else rows multiply, which ``many_to_many`` says is meant.

    The rows are those of joining the two masked tables on the hashed
    identifier, but the join runs on the clear one and the masks after it, so
    each digest is computed once per result row and truncated digests cannot
    collide. Columns of the right side get its table name as prefix. Tables
    that arrive masked are joined with `spread_join`; both must then come from
    one tier and one salt, as a hashed side matches nothing in a clear one.
    """
    if on != TABLES[right_table].key and not many_to_many:
        raise ValueError(f"{right_table} may have several rows per {on}; say many_to_many=True")
    prefix = f"{right_table}_"
    parent = right.select(*[F.col(c).alias(prefix + c) for c in right.columns])
    policy = {
        **TABLES[left_table].policy,
        **{prefix + c: fn for c, fn in TABLES[right_table].policy.items()},
    }
    row_id = [TABLES[left_table].key]
    joined = spread_join(left, parent, on, prefix + on, row_id)
    return masked(joined, policy, tier, salt, projected=True)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent and how many child rows use each.

    NULL references nothing. Both sides are reduced to distinct keys first.
    """
    used = (
        child.where(F.col(fk).isNotNull())
        .groupBy(F.col(fk).alias("key_value"))
        .agg(F.count("*").alias("n_rows"))
    )
    known = parent.select(F.col(pk).alias("key_value")).distinct()
    return used.join(known, "key_value", "left_anti")


def member_rows(
    child: DataFrame, members: DataFrame, columns: Sequence[str], row_id: Sequence[str]
) -> DataFrame:
    """Child rows with columns of their member, NULL where the member is unknown."""
    parent = members.select(
        F.col("member_id").alias("m_member_id"),
        *[F.col(c).alias(f"member_{c}") for c in columns],
    )
    joined = spread_join(child, parent, "member_id", "m_member_id", row_id, "left")
    return joined.drop("m_member_id")


def claim_authorizations(claims: DataFrame, authorizations: DataFrame) -> DataFrame:
    """Every claim with the request its authorization number names, if any.

    Most claims need no authorization, so the NULL numbers are the hot group.
    """
    requests = authorizations.select("auth_id", "auth_type", "auth_status")
    return spread_join(
        claims.select("claim_id", "claim_status", "authorization_number"),
        requests,
        "authorization_number",
        "auth_id",
        ["claim_id"],
        "left",
    )
