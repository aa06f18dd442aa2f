"""Neighbours and positions inside ordered groups of any size.

A plain window holds a whole group in one task. That is the best plan while groups are
small: one exchange, one sort. ``plan_order`` counts the groups; when one is too large the
total order ``keys, by`` is cut into contiguous slices. Cut points are evenly spaced rows of
a hash sample of the large groups, and because ``by`` ends in a unique column a group is
split even when all its rows have the same time.

Windows then run per group and slice. Cut points are literals of the plan, so a task that is
computed again after a lost executor sees the same slices. Rows that
windows need across a cut (at most ``ahead + behind`` per cut) are copied to the slices that
need them, and positions are the local position plus the rows of earlier slices. Null keys are a
group like any other and null sort values come first, in either plan.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_GROUP_ROWS = 2_000_000
MAX_SLICES = 20_000
SAMPLES_PER_SLICE = 20
_SAMPLE_SPACE = 1 << 40
_SLICE, _COPY, _RANK = "_slice", "_copy", "_rank"


@dataclass(frozen=True)
class RowOrder:
    """How rows are grouped and sorted, and where the total order is cut (if at all)."""

    keys: tuple[str, ...]
    by: tuple[str, ...]
    cuts: tuple[tuple, ...] = ()
    types: tuple[str, ...] = ()  # SQL types of keys and by, for null values in cuts

    @property
    def sliced(self) -> bool:
        return bool(self.cuts)

    def _tuple_sql(self, names: tuple[str, ...], values: tuple) -> str:
        kinds = dict(zip(self.keys + self.by, self.types, strict=True))
        return "named_struct(" + ", ".join(
            f"'{n}', " + (_literal(v) if v is not None else f"CAST(NULL AS {kinds[n]})")
            for n, v in zip(names, values, strict=True)
        ) + ")"

    def _cut_array(self, width: int) -> str:
        names = (self.keys + self.by)[:width]
        return "array(" + ", ".join(self._tuple_sql(names, c[:width]) for c in self.cuts) + ")"

    def _row_sql(self, names: tuple[str, ...]) -> str:
        return "named_struct(" + ", ".join(f"'{n}', `{n}`" for n in names) + ")"

    def slice_column(self) -> Column:
        """Number of cuts at or below the row, by binary search in a literal array."""
        n = len(self.cuts)
        steps = ", ".join(str(1 << p) for p in reversed(range(n.bit_length())))
        names = self.keys + self.by
        return F.expr(
            f"aggregate(array({steps}), 0, (lo, step) -> if(lo + step <= {n} and "
            f"element_at({self._cut_array(len(names))}, lo + step) <= {self._row_sql(names)}, "
            "lo + step, lo))"
        )

    def continues_at(self, cut: Column) -> Column:
        """Whether the row's group is the one cut number ``cut`` (1-based) falls into."""
        groups = F.expr(self._cut_array(len(self.keys)))
        row = F.expr(self._row_sql(self.keys))
        inside = cut.between(F.lit(1), F.lit(len(self.cuts)))
        return F.when(inside, F.element_at(groups, cut) == row).otherwise(F.lit(False))


def _literal(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return f"{value}L"
    if isinstance(value, float):
        return f"double('{value!r}')"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE'{value.isoformat()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def plan_order(
    df: DataFrame,
    keys: tuple[str, ...],
    by: tuple[str, ...],
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> RowOrder:
    """Choose between whole groups and slices from the size of the largest group.

    One aggregation over the key columns. A second pass over the key and sort columns runs
    only when a group is too large; it brings about ``SAMPLES_PER_SLICE * slices`` rows, at
    most 400 000, to the driver.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    too_large = F.col("n") > max_group_rows
    crowded = counts.agg(F.sum(F.when(too_large, F.col("n"))).alias("rows")).first()["rows"]
    if not crowded:
        return RowOrder(tuple(keys), tuple(by))
    if slices is None:
        parallel = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slices = min(MAX_SLICES, max(parallel, math.ceil(crowded / max(max_group_rows, 1))))
    large = counts.where(too_large).select(*keys)
    types = tuple(kind for _, kind in df.select(*keys, *by).dtypes)
    return RowOrder(
        tuple(keys), tuple(by), _sample_cuts(df, keys, by, large, crowded, slices), types)


def _same(keys: tuple[str, ...], prefix: str) -> Column:
    """Equal keys; null keys are a group like any other."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def _sample_cuts(df, keys, by, large: DataFrame, crowded: int, slices: int) -> tuple[tuple, ...]:
    """Evenly spaced rows of a hash sample of the groups that are too large."""
    wanted = SAMPLES_PER_SLICE * slices
    share = max(1, math.ceil(_SAMPLE_SPACE * min(1.0, wanted / crowded)))
    columns = [*keys, *by]
    sample = (
        df.select(*columns)
        .where(F.pmod(F.xxhash64(*columns), F.lit(_SAMPLE_SPACE)) < share)
        .join(large.toDF(*[f"_large_{k}" for k in keys]), _same(tuple(keys), "_large_"), "left_semi")
        .orderBy(*columns)
        .collect()
    )
    picks = sorted({len(sample) * i // slices for i in range(slices)})
    cuts = dict.fromkeys(tuple(sample[i]) for i in picks if i < len(sample))
    return tuple(cuts)


def ordered_columns(
    df: DataFrame,
    order: RowOrder,
    columns: Mapping[str, Callable[[Window], Column]],
    ahead: int = 0,
    behind: int = 0,
    position: str | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add window columns that look at most ``ahead`` / ``behind`` rows away in the group.

    ``position`` names a 1-based row number in the group, ``total`` the size of the group.
    """
    if not order.sliced:
        window = Window.partitionBy(*order.keys).orderBy(*order.by)
        added = [make(window).alias(name) for name, make in columns.items()]
        if position:
            added.append(F.row_number().over(window).cast("long").alias(position))
        if total:
            whole = Window.partitionBy(*order.keys)
            added.append(F.count(F.lit(1)).over(whole).alias(total))
        return df.select("*", *added)

    sliced = df.withColumn(_SLICE, order.slice_column())
    rows = sliced.withColumn(_COPY, F.lit(False))
    for count, forward in ((ahead, True), (behind, False)):
        if count:
            rows = rows.unionByName(_copies(sliced, order, count, forward))

    window = Window.partitionBy(*order.keys, _SLICE).orderBy(*order.by)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(F.col(_COPY), 0).otherwise(1)
    added = [make(window).alias(name) for name, make in columns.items()]
    if position:
        added.append(F.sum(own).over(so_far).alias(_RANK))
    out = rows.select("*", *added).where(~F.col(_COPY)).drop(_COPY)
    if position or total:
        out = _with_offsets(out, sliced, order, position, total)
    return out.select(*df.columns, *columns, *[c for c in (position, total) if c])


def _copies(sliced: DataFrame, order: RowOrder, count: int, forward: bool) -> DataFrame:
    """Rows next to a cut, addressed to every slice that must see them.

    Only the group a cut falls into can reach over it, so at most ``count`` rows per cut are
    found; the partial group limit keeps the shuffle at that size per task.
    """
    cut = F.col(_SLICE) if forward else F.col(_SLICE) + 1
    sort = [F.asc(c) if forward else F.desc(c) for c in order.by]
    nearest = Window.partitionBy(_SLICE).orderBy(*sort)
    edge = (
        sliced.where(order.continues_at(cut))
        .withColumn(_RANK, F.row_number().over(nearest))
        .where(F.col(_RANK) <= count)
        .drop(_RANK)
    )
    # A copy is needed as far as the slice of the count-th edge row before it; slices
    # between the two hold fewer than ``count`` rows of the group.
    group = Window.partitionBy(*order.keys)
    reach = F.lag(_SLICE, count).over(group.orderBy(*sort))
    if forward:
        far = F.coalesce(reach, F.min(_SLICE).over(group) - 1)
        targets = F.sequence(far, F.col(_SLICE) - 1)
    else:
        far = F.coalesce(reach, F.max(_SLICE).over(group) + 1)
        targets = F.sequence(F.col(_SLICE) + 1, far)
    others = [c for c in sliced.columns if c != _SLICE]
    return edge.withColumn("_targets", targets).select(
        *others, F.explode("_targets").alias(_SLICE), F.lit(True).alias(_COPY)
    )


def _with_offsets(out, sliced, order: RowOrder, position, total) -> DataFrame:
    """Join per-slice row counts (at most groups + slices rows) on the window's own keys."""
    counts = sliced.groupBy(*order.keys, _SLICE).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*order.keys)
    before = group.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"_of_{k}") for k in order.keys],
        F.col(_SLICE).alias(f"_of_{_SLICE}"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias("_total"),
    )
    out = out.join(offsets, _same((*order.keys, _SLICE), "_of_"))
    if position:
        out = out.withColumn(position, F.col("_before") + F.col(_RANK))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out
