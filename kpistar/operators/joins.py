"""Join helpers.

Dimension lookups are broadcast only behind a size check: the optimizer's
size estimate of the dimension plan must be below a bound.  Above the bound
the join is left to Spark (sort-merge join, AQE may still convert it at
runtime from real shuffle statistics).  Fact-to-fact joins never get a hint.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Session setting: largest estimated size (bytes) of a side that is broadcast, and its default.
LIMIT_KEY, DEFAULT_LIMIT = "spark.kpistar.broadcastLimit", 32 * 1024 * 1024


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(LIMIT_KEY, str(DEFAULT_LIMIT)))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (no job is run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # no estimate available: treat as unbounded
        return 1 << 62


def is_bounded(df: DataFrame) -> bool:
    return estimated_bytes(df) <= broadcast_limit(df)


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """``broadcast(df)`` if its estimated size is within the session's limit, else ``df``."""
    return F.broadcast(df) if is_bounded(df) else df


def lookup(left: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a dimension (N:1 or small 1:N) to ``left``, broadcasting it when bounded."""
    return left.join(bounded_broadcast(dim), on, how)


def single_row_lookup(left: DataFrame, key: Column, table: DataFrame, table_key: str, values: dict[str, str]) -> DataFrame:
    """``left`` with columns of ``table`` (name there -> name here) looked up by ``key``, as
    correlated scalar subqueries give them: NULL without a row, and an error as soon as a row
    of ``left`` asks for a key that has a second one (keys that nobody asks for may repeat).

    The table is reduced to one row per key with its count, so ``left``'s rows never multiply;
    a key held by many rows of ``left`` is on the preserved, splittable side."""
    rows = table.where(F.col(table_key).isNotNull()).groupBy(F.col(table_key).alias("_lookup")).agg(
        F.count(F.lit(1)).alias("_found"), *[F.first(v).alias(f"_value_{v}") for v in values])
    j = left.join(bounded_broadcast(rows), key == F.col("_lookup"), "left")
    refused = F.raise_error(F.concat(F.lit(f"more than one row returned by a lookup of {table_key} "), F.col("_lookup").cast("string")))
    for v, name in values.items():
        kind = table.schema[v].dataType
        j = j.withColumn(name, F.when(F.col("_found") > 1, refused.cast(kind)).otherwise(F.col(f"_value_{v}")))
    return j.drop("_lookup", "_found", *[f"_value_{v}" for v in values])


def anti_orphans(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                 right_cols: list[str] | None = None) -> DataFrame:
    """``left LEFT JOIN right ... WHERE right.key IS NULL`` as a left-anti join.

    Rows with a NULL foreign key are kept (they match nothing), and the right
    side's columns are appended as typed NULLs so the output keeps the shape of
    the outer-join text.
    """
    out = left.join(right, left[left_key] == right[right_key], "left_anti")
    for name in (right_cols if right_cols is not None else []):
        out = out.withColumn(name, F.lit(None).cast(right.schema[name].dataType))
    return out


def fact(df: DataFrame) -> DataFrame:
    """Mark a fact-grain join side: never broadcast, shuffle both sides (sort-merge).

    Catalyst's size estimate of a parquet scan is its compressed file size, so
    a fact table can look small enough to broadcast; the hint keeps the join a
    shuffle join whatever the estimate says.
    """
    return df.hint("merge")


def fact_led(left: DataFrame, right: DataFrame, on: list[tuple[Column, str]], nullable: bool = True,
             keys_of: DataFrame | None = None) -> DataFrame:
    """``left LEFT JOIN right`` on (left key, name of the right key) pairs, where ``right``
    is a fact that may hold a hot key and ``left`` a wide plan to be evaluated once.

    A skewed partition of the right (null-supplying) side of a left outer join cannot be
    split by AQE, so one hot key would land in one task.  Here the fact leads:

        (right UNION ALL keys of left that right lacks, right columns NULL)  INNER JOIN  left

    The inner join's skewed partitions can be split on either side.  The added keys need
    only the key columns of both sides, and the distinct of ``left``'s lets Catalyst drop
    its outer joins there.  ``nullable=False`` promises that left keys are never NULL (a
    primary key) and makes the join a plain equality, which tables bucketed by it need.
    ``keys_of`` holds the keys of ``right`` under the same names, where ``right`` is a plan
    that should not run twice for them.
    """
    keys = [f"_fact{i}" for i in range(len(on))]
    have = (right if keys_of is None else keys_of).select(*[F.col(r).alias(f"_have{i}") for i, (_, r) in enumerate(on)]).distinct()
    asked = left.select(*[k.alias(n) for n, (k, _) in zip(keys, on)]).distinct()
    lone = asked.join(fact(have), reduce(and_, [asked[n] == have[f"_have{i}"] for i, n in enumerate(keys)]), "left_anti")
    lone = lone.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields], *keys)
    known = right.where(reduce(and_, [F.col(r).isNotNull() for _, r in on]))
    facts = known.select("*", *[F.col(r).alias(n) for n, (_, r) in zip(keys, on)]).unionByName(lone)
    same = [k.eqNullSafe(facts[n]) if nullable else k == facts[n] for n, (k, _) in zip(keys, on)]
    return left.join(fact(facts), reduce(and_, same), "inner").drop(*keys)


#: Pieces that the rows of one key are dealt into by ``left_join_many``, where a key has ``MANY`` rows or more.
PIECES, MANY = 64, 256


def _keyed(right: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """The rows of ``right`` whose keys are known, and the piece that a row's hash gives it."""
    return right.where(reduce(and_, [F.col(r).isNotNull() for r in keys])), F.pmod(F.xxhash64(*right.columns), F.lit(PIECES))


def large_key_pieces(right: DataFrame, keys: list[str]) -> DataFrame:
    """The pieces (``_many0``, ..., ``_of``) of the keys with ``MANY`` rows or more; at most ``PIECES`` of a key."""
    known, piece = _keyed(right, keys)
    names = [f"_many{i}" for i in range(len(keys))]
    return (known.select(*[F.col(r).alias(n) for n, r in zip(names, keys)], piece.alias("_of"))
            .groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"), F.collect_set("_of").alias("_ofs")).where(F.col("_rows") >= MANY)
            .select(*names, F.explode("_ofs").alias("_of")))


def left_join_many(left: DataFrame, right: DataFrame, on: list[tuple[Column, str]], pieces: DataFrame | None = None,
                   side=bounded_broadcast) -> DataFrame:
    """``left LEFT JOIN right`` for a 1:N right side (memberships, posts), ``left`` evaluated once.

    The right rows of a key with ``MANY`` rows or more are dealt into pieces by their hash, those
    of other keys are one piece.  A left row first meets the pieces of its key, then, on key and
    piece, the rows of each: a key with a third of all right rows is spread over its pieces, a
    hot left key is on the preserved side, which AQE splits.  A left row is copied no more often
    than it has matches.  ``pieces`` are the ``large_key_pieces`` of ``right``: from a written
    table, whose measured size lets them be broadcast, the left rows move once, for their
    matches.  One program at every size; sides under the broadcast limit are broadcast, the right
    rows only unless ``side`` is ``fact``, for a right side that grows with the data."""
    names = [f"_many{i}" for i in range(len(on))]
    known, piece = _keyed(right, [r for _, r in on])
    pieces = large_key_pieces(right, [r for _, r in on]) if pieces is None else pieces
    large = pieces.select(*[F.col(n).alias(f"_large{n}") for n in names]).distinct()
    known = known.join(bounded_broadcast(large), reduce(and_, [known[r] == large[f"_large{n}"] for n, (_, r) in zip(names, on)]), "left")
    known = known.select(*right.columns, F.when(F.col(f"_large{names[0]}").isNull(), F.lit(0)).otherwise(piece).alias("_piece"))
    j = left.join(bounded_broadcast(pieces), reduce(and_, [k == pieces[n] for n, (k, _) in zip(names, on)]), "left")
    j = j.withColumn("_of", F.coalesce(F.col("_of"), F.lit(0)))
    j = j.join(side(known), reduce(and_, [k == known[r] for k, r in on], j["_of"] == known["_piece"]), "left")
    return j.drop("_of", "_piece", *names)


def full_outer_dim(fact_side: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """``fact FULL JOIN dim`` where ``dim`` is unique on its key.

    FULL OUTER joins cannot have skewed partitions split, so a dimension key
    held by a third of the fact rows would be one task.  Same rows as
    ``(fact LEFT JOIN dim) UNION ALL (dim ANTI JOIN distinct fact keys, fact columns NULL)``;
    the left join keeps the hot key on its splittable side.
    """
    left = fact_side.join(dim, fact_side[fact_key] == dim[dim_key], "left")
    keys = fact_side.select(F.col(fact_key).alias("_full_key")).distinct()
    alone = dim.join(keys, dim[dim_key] == keys["_full_key"], "left_anti")
    for f in fact_side.schema.fields:
        alone = alone.withColumn(f.name, F.lit(None).cast(f.dataType))
    return left.unionByName(alone.select(*left.columns))
