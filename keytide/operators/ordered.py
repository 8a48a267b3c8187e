"""Row numbering, carrying forward and running totals within a key, at any key size.

A window per key sends all rows of the key to one task. That is fine up to
``Limits.hot_rows``. Larger keys are cut into segments of about ``Limits.segment_rows`` rows: a sample of each key's
positions, sorted, gives its cut points, a small table that is broadcast; every row finds its segment by binary search. So the
rows of hot keys move once, by (key, segment). Windows run per segment, their
result is written once, and what the earlier segments of the key contribute is read off the
last row of each segment.

Segments of a key are contiguous, so at most ``Limits.segments`` (key, segment) pairs have
an earlier segment of the same key. That bounds the rows of every carried table; these are broadcast if their bytes allow it,
and joined by shuffle otherwise. Beyond ``segments`` times ``segment_rows`` hot rows (10^11) segments grow with the log.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from keytide.operators.sizes import light
from keytide.settings import DEFAULT_LIMITS, Limits, written_table

SEGMENT = "_segment"
SAMPLES = 16  # positions sampled per segment
_LAST, _CUTS, _ALL = "_last", "_cuts", "_all"


class Scope:
    """The keys and order a step works in, and whether keys are cut into segments."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], segmented: bool, limits: Limits = DEFAULT_LIMITS):
        self.keys, self.order, self.segmented, self.limits = list(keys), list(order), segmented, limits
        self.group = [*self.keys, SEGMENT] if segmented else self.keys
        self.ordered = Window.partitionBy(*self.group).orderBy(*self.order)
        self.so_far = self.ordered.rowsBetween(Window.unboundedPreceding, 0)
        self.by_segment = Window.partitionBy(*self.keys).orderBy(SEGMENT)
        self.earlier_segments = self.by_segment.rowsBetween(Window.unboundedPreceding, -1)

    def attach(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        """Add the carried columns (at most one row per segment) to the rows they apply to."""
        return _attached(rows, written_table(carry, "carried"), self.group, "left", self.limits)


def _attached(rows: DataFrame, few: DataFrame, keys: Sequence[str], how: str, limits: Limits) -> DataFrame:
    """``few`` joined by ``keys``, nulls equal: broadcast if its bytes allow it, else by shuffle."""
    renamed = few.withColumnsRenamed({name: f"_c_{name}" for name in keys})
    same = [F.col(name).eqNullSafe(F.col(f"_c_{name}")) for name in keys]
    joined = rows.join(F.broadcast(renamed) if light(few, limits) else renamed.hint("merge"), same, how)
    return joined.drop(*[f"_c_{name}" for name in keys])


@dataclass(frozen=True)
class Step:
    """What to compute within a key.

    ``local`` adds columns by windows of the scope; for whole keys that is the answer. For cut
    keys ``finish`` corrects them, given the last row of every segment.
    """

    local: Callable[[DataFrame, Scope], DataFrame]
    finish: Callable[[DataFrame, DataFrame, Scope], DataFrame]


def hot_keys(df: DataFrame, keys: Sequence[str], limits: Limits = DEFAULT_LIMITS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, and their ``_rows``; None if there are none.

    A key counts as hot from 1 / ``limits.hot_keys`` of the log at the least, so there are fewer
    than that many. A log that is small as a whole is not grouped.
    """
    total = df.count()
    threshold = max(limits.hot_rows, total // limits.hot_keys)
    if total <= threshold:
        return None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = written_table(counts.where(F.col("_rows") > threshold), "hot-keys")
    return None if hot.isEmpty() else hot


def flag_hot(
    df: DataFrame, keys: Sequence[str], hot: DataFrame, mark: Column, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Add ``mark`` (an expression over ``_rows``) to the rows of hot keys, null to the others."""
    return _attached(df, hot.select(*keys, mark), keys, "left", limits)


def apply_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Step,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Run ``step`` within each key in order; rows of hot keys are segmented first.

    Without keys the whole log is one group.
    """
    whole = Scope(keys, order, segmented=False)
    if not keys:
        total = df.count()
        if total <= limits.hot_rows:
            return step.local(df, whole)
        one = df.sparkSession.range(1).select(F.lit(0).alias(_ALL), F.lit(total).alias("_rows"))
        return _in_segments(df.withColumn(_ALL, F.lit(0)), [_ALL], order, step, one, limits).drop(_ALL)
    hot = hot_keys(df, keys, limits)
    if hot is None:
        return step.local(df, whole)
    flagged = flag_hot(df, keys, hot, F.lit(True).alias("_hot"), limits)
    cold = step.local(flagged.where(F.col("_hot").isNull()).drop("_hot"), whole)
    return cold.unionByName(_in_segments(df, keys, order, step, hot, limits))


def cut_points(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: DataFrame, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """For each of the keys ``hot``, the positions (structs of ``order``) at which its segments after the first begin."""
    total = hot.agg(F.sum("_rows")).first()[0]
    size = max(limits.segment_rows, -(-total // limits.segments))
    share = min(1.0, SAMPLES / size)
    rows = _attached(df.select(*keys, F.struct(*order).alias("_at")), hot, keys, "inner", limits)
    sampled = rows if share == 1.0 else rows.sample(share, 7)
    sorted_ = sampled.groupBy(*keys, "_rows").agg(F.sort_array(F.collect_list("_at")).alias("_held"))
    pieces = F.greatest(F.lit(2), F.ceil(F.col("_rows") / size)).cast("int")
    places = F.sequence(F.lit(1), pieces - 1)
    cuts = F.transform(places, lambda i: F.element_at("_held", (F.floor(i * F.size("_held") / pieces) + 1).cast("int")))
    return sorted_.select(*keys, F.array_distinct(cuts).alias(_CUTS))


def in_segments(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: DataFrame, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """The rows of the keys ``hot`` with the number of their segment; they do not move."""
    found = written_table(cut_points(df, keys, order, hot, limits), "cut-points")
    cuts = _attached(hot.select(*keys), found, keys, "left", limits)  # a key that no sample met is one segment
    longest = cuts.agg(F.coalesce(F.max(F.size(_CUTS)), F.lit(0))).first()[0]
    at = F.struct(*order)

    def further(place: Column, jump: Column) -> Column:
        on = (place + jump <= F.size(_CUTS)) & (F.try_element_at(_CUTS, place + jump) <= at)  # null without cuts
        return F.when(on, place + jump).otherwise(place)

    jumps = F.array(*[F.lit(1 << bit) for bit in reversed(range(max(1, longest.bit_length())))])
    held = _attached(df, cuts, keys, "inner", limits)
    return held.withColumn(SEGMENT, F.aggregate(jumps, F.lit(0), further)).drop(_CUTS)


def _in_segments(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], step: Step, hot: DataFrame, limits: Limits
) -> DataFrame:
    scope = Scope(keys, order, segmented=True, limits=limits)
    cut = in_segments(df, keys, order, hot, limits)
    local = step.local(cut, scope).withColumn(_LAST, F.lead(F.lit(True)).over(scope.ordered).isNull())
    # Written, so that rows and segment ends agree, and the windows run once.
    written = written_table(local, "segments")
    ends = written.where(F.col(_LAST)).drop(_LAST)
    return step.finish(written.drop(_LAST), ends, scope).drop(SEGMENT)


def numbered(out: str) -> Step:
    """1, 2, 3, … within the key."""
    return Step(
        lambda rows, scope: rows.withColumn(out, F.row_number().over(scope.ordered).cast("bigint")),
        lambda rows, ends, scope: _plus_earlier(rows, ends, scope, out),
    )


def positions(df: DataFrame, by: str, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """``df`` with ``by`` replaced by the rows' numbers in its order, from 0."""
    counted = apply_in_order(df, [], [by], numbered("_number"), limits)
    return counted.withColumn(by, F.col("_number") - 1).drop("_number")


def running_sum(value: str | Column, out: str) -> Step:
    """Sum of ``value`` over this and all earlier rows of the key."""
    return Step(
        lambda rows, scope: rows.withColumn(out, F.sum(value).over(scope.so_far)),
        lambda rows, ends, scope: _plus_earlier(rows, ends, scope, out),
    )


def _plus_earlier(rows: DataFrame, ends: DataFrame, scope: Scope, out: str) -> DataFrame:
    carry = ends.select(*scope.group, F.sum(out).over(scope.earlier_segments).alias("_carried"))
    attached = scope.attach(rows, carry.where(F.col("_carried").isNotNull()))
    total = F.when(F.col("_carried").isNull(), F.col(out)).otherwise(
        F.col("_carried") + F.coalesce(F.col(out), F.lit(0))
    )
    return attached.withColumn(out, total).drop("_carried")


def last_value(value: str | Column, out: str) -> Step:
    """The newest non-null ``value`` up to this row."""

    def finish(rows: DataFrame, ends: DataFrame, scope: Scope) -> DataFrame:
        newest = F.last(out, ignorenulls=True).over(scope.earlier_segments)
        carry = ends.select(*scope.group, newest.alias("_carried"))
        attached = scope.attach(rows, carry.where(F.col("_carried").isNotNull()))
        return attached.withColumn(out, F.coalesce(F.col(out), F.col("_carried"))).drop("_carried")

    return Step(
        lambda rows, scope: rows.withColumn(out, F.last(value, ignorenulls=True).over(scope.so_far)), finish
    )
