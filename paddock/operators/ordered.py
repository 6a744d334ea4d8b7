"""Aggregates over the rows that come before a row, safe for very long histories.

A plain window puts all rows of one key into one task, and a key may hold a third of all
rows.  Here the rows are stored range-partitioned by key and order, in parts of a bounded
number of rows, and a window partition is a key within a part.  Each of them receives

* the rows of the key that end before the part, as many as the longest frame looks back,
  from as many earlier parts as it takes, and
* one row with the totals of all earlier parts, for frames over everything.

Results do not depend on where the parts begin.

``lay_out`` makes the parts by a range partitioning, for any order.  ``cut_by_event`` leaves
the rows where they are: only keys longer than a part are cut, between two events of the
order, and all other keys need neither a copy nor rows from earlier parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.scratch import materialize

CHUNK_ROWS = 1_000_000
# parts of small tables: no smaller than this, as long as chunk_rows allows it
FEW_ROWS = 50_000
# a table of so many starts of events is small enough for every task
MOST_STARTS = 200_000

_PART, _KIND, _RANK = "_part", "_kind", "_rank"
_BEFORE, _ROWS, _NEXT, _GAP, _TO = "_before", "_rows", "_next", "_gap", "_to"
_OWN, _HALO, _CARRY = 2, 1, 0


@dataclass(frozen=True)
class Laid:
    """A stored table whose parts follow each other in the order of every key.

    ``long`` are the keys that have several parts, where these are known, and ``starts`` the
    parts of their events; ``whole`` says that there are none.
    """

    table: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    columns: tuple[str, ...]
    long: DataFrame | None = None
    starts: DataFrame | None = None
    whole: bool = False


def _part_rows(rows: DataFrame, total: int, chunk_rows: int) -> int:
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(chunk_rows, max(FEW_ROWS, -(-total // tasks)))


def lay_out(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int = CHUNK_ROWS
) -> Laid:
    """Store ``rows`` in parts of about ``chunk_rows`` rows at most, by key and order.

    ``rows`` should be a stored table: it is counted, sampled and written.
    """
    total = rows.count()
    parts = max(1, -(-total // _part_rows(rows, total, chunk_rows)))
    by = dict.fromkeys((*keys, *order))
    # nulls, too, are in one place of the order
    ranged = rows.repartitionByRange(parts, *[F.col(c) for c in by])
    table = materialize(ranged.withColumn(_PART, F.spark_partition_id()), "laid_out")
    return Laid(table, tuple(keys), tuple(order), tuple(rows.columns))


def cut_by_event(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    event: Sequence[str],
    chunk_rows: int = CHUNK_ROWS,
) -> Laid:
    """Give the rows of long keys a part, between events, the first columns of the order.

    ``rows`` should be a stored table: it is counted, and read again where it is used, but
    not written.  A part has about ``chunk_rows`` rows and those of one event at most, and
    the number of events of a key must suit a task.
    """
    if tuple(order[: len(event)]) != tuple(event):
        raise ValueError(f"the order does not begin with {event}")
    size = _part_rows(rows, rows.count(), chunk_rows)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS))
    long = materialize(sizes.where(F.col(_ROWS) > size).select(*keys), "long_keys")
    laid = (tuple(keys), tuple(order), tuple(rows.columns))
    if long.isEmpty():
        return Laid(rows.withColumn(_PART, F.lit(0)), *laid, whole=True)
    events = [c for c in event if c not in keys]
    counted = _match(rows.select(*keys, *events), long, keys).groupBy(*keys, *events).agg(
        F.count(F.lit(1)).alias(_ROWS)
    )
    # one row for each event of a key
    along = Window.partitionBy(*keys).orderBy(*events).rowsBetween(Window.unboundedPreceding, -1)
    part = F.floor(F.coalesce(F.sum(_ROWS).over(along), F.lit(0)) / size).cast("int")
    starts = materialize(counted.select(*keys, *events, part.alias(_PART)), "parts")
    if starts.count() <= MOST_STARTS:
        starts = F.broadcast(starts)
    cut = Laid(rows, *laid, long, starts)
    return replace(cut, table=with_parts(cut, rows))


@dataclass(frozen=True)
class Past:
    """An aggregate over earlier rows: ``sum`` or ``count`` of a column.

    ``count`` without a column counts rows.  ``depth`` is the number of rows looked
    back; None means all of them.
    """

    how: str
    column: str | None = None
    depth: int | None = None

    def value(self) -> Column:
        """What one row adds."""
        if self.how == "sum":
            return F.col(self.column)
        if self.column is None:
            return F.lit(1)
        return F.col(self.column).isNotNull().cast("int")


def _match(rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL; the columns of ``side`` are prefixed away."""
    renamed = side.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.col(c) for c in side.columns if c not in keys],
    )
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    )
    return rows.join(renamed, condition, how).drop(*[f"_key_{k}" for k in keys])


def prior(
    laid: Laid,
    wanted: Mapping[str, Past],
    keys: Sequence[str] | None = None,
    onto: DataFrame | None = None,
    keep_part: bool = False,
) -> DataFrame:
    """Add aggregates over earlier rows of the same key; the row itself never counts.

    A sum over no rows is NULL, a count 0.  The order must be total within a key.
    ``keys`` may split the keys of the layout further: their rows follow the same parts.
    ``onto`` are the rows of the layout with columns added by an earlier call that kept the
    part: several windows then go over the same rows, which are not joined again.
    """
    keys = list(laid.keys if keys is None else keys)
    if not set(laid.keys) <= set(keys):
        raise ValueError(f"the rows are laid out by {laid.keys}")
    deep = {f"_value_{name}": past.value() for name, past in wanted.items() if past.depth is None}
    depth = max([p.depth for p in wanted.values() if p.depth is not None], default=0)
    rows = laid.table if onto is None else onto
    carried = [c for c in rows.columns if c != _PART]
    together = rows.withColumn(_KIND, F.lit(_OWN))
    part = [] if laid.whole else [_PART]
    if not laid.whole:
        sources = [p.column for p in wanted.values() if p.column is not None]
        narrow = laid.table.select(*dict.fromkeys((*keys, _PART, *laid.order, *sources))).withColumns(deep)
        if laid.long is not None:
            narrow = _match(narrow, laid.long, laid.keys)
        parts = [together, *_from_earlier_parts(narrow, keys, laid.order, list(deep), depth)]
        together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if onto is None or not laid.whole:
        # placed as they are: what the windows add up is made where the rows lie
        together = together.repartition(*laid.keys, *part)
    window = Window.partitionBy(*keys, *part).orderBy(*([] if laid.whole else [_KIND]), *laid.order)

    def added(name: str, past: Past) -> Column:
        if laid.whole:
            return past.value()
        # the totals of earlier parts are one row, for frames over everything only, and these
        # totals hold the last rows of earlier parts
        kind = F.col(_KIND)
        if past.depth is not None:
            return F.when(kind != _CARRY, past.value())
        return F.when(kind == _OWN, past.value()).when(kind == _CARRY, F.col(f"_value_{name}"))

    def over(name: str, past: Past) -> Column:
        start = Window.unboundedPreceding if past.depth is None else -past.depth
        total = F.sum(f"_value_{name}").over(window.rowsBetween(start, -1))
        return total if past.how == "sum" else F.coalesce(total, F.lit(0))

    together = together.withColumns({f"_value_{name}": added(name, past) for name, past in wanted.items()})
    sums = {name: over(name, past) for name, past in wanted.items()}
    kept = [_PART] if keep_part else []
    return together.withColumns(sums).where(F.col(_KIND) == _OWN).select(*carried, *kept, *wanted)


def with_parts(laid: Laid, rows: DataFrame) -> DataFrame:
    """Rows of another layout, with their part in this one; ``onto`` of ``prior`` takes them."""
    rows = without_parts(rows)
    if laid.whole:
        rows = rows.repartition(*laid.keys)
    if laid.starts is None:
        return rows.withColumn(_PART, F.lit(0))
    placed = _match(rows, laid.starts, [c for c in laid.starts.columns if c != _PART], "left")
    return placed.withColumn(_PART, F.coalesce(_PART, F.lit(0)))


def without_parts(rows: DataFrame) -> DataFrame:
    return rows.drop(_PART)


def _from_earlier_parts(
    rows: DataFrame, keys: list[str], order: Sequence[str], deep: list[str], depth: int
) -> list[DataFrame]:
    """Rows that stand in front of each key of each part."""
    sizes = rows.groupBy(*keys, _PART).agg(
        F.count(F.lit(1)).alias(_ROWS), *[F.sum(c).alias(c) for c in deep]
    )
    # one row for each part of a key
    along = Window.partitionBy(*keys).orderBy(_PART)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    running = sizes.withColumn(_BEFORE, F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)))
    found = []
    if deep:
        totals = running.select(
            *keys, _PART, _BEFORE, *[F.sum(c).over(earlier).alias(c) for c in deep]
        )
        found.append(totals.where(F.col(_BEFORE) > 0).drop(_BEFORE).withColumn(_KIND, F.lit(_CARRY)))
    if depth:
        # a part holds a row of the key at least, so ``depth`` parts on nothing is missing
        following = F.collect_list(F.struct(F.col(_PART).alias(_TO), F.col(_BEFORE))).over(
            along.rowsBetween(1, depth)
        )
        each = running.withColumn(_NEXT, following).select(
            *keys, _PART, (F.col(_BEFORE) + F.col(_ROWS)).alias("_end"), F.explode(_NEXT).alias(_NEXT)
        )
        gap = F.col(f"{_NEXT}.{_BEFORE}") - F.col("_end")
        wanting = each.select(*keys, _PART, F.col(f"{_NEXT}.{_TO}").alias(_TO), gap.alias(_GAP))
        # few rows; stored, their true size decides how they are joined
        wanting = materialize(wanting.where(F.col(_GAP) < depth), "part_ends")
        from_end = Window.partitionBy(*keys, _PART, _TO).orderBy(*[F.col(c).desc() for c in order])
        found.append(
            _match(rows.drop(*deep), wanting, [*keys, _PART])
            .withColumn(_RANK, F.row_number().over(from_end))
            .where(F.col(_RANK) <= depth)
            .where(F.col(_RANK) + F.col(_GAP) <= depth)
            .withColumn(_PART, F.col(_TO))
            .drop(_RANK, _GAP, _TO)
            .withColumn(_KIND, F.lit(_HALO))
        )
    return found
