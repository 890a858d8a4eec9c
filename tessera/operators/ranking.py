"""Row numbers, ranks and percentiles.

A window without partition columns, or with few, puts a whole group into one task. The operators
here give the same numbers from range-partitioned rows: a position inside the range, plus what the
ranges before it hold.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import materialise

# monotonically_increasing_id() is the partition number above 33 bits of position.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def _match(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    condition = F.lit(True)
    for n in names:
        condition = condition & left[n].eqNullSafe(right[f"__{n}"])
    return condition


def _ranges(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Rows written in the order of the keys, with their range ``__part`` and position ``__pos``."""
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = ordered.withColumn("__id", F.monotonically_increasing_id())
    placed = numbered.withColumns(
        {
            "__part": F.shiftright("__id", _POSITION_BITS).cast("int"),
            "__pos": F.col("__id").bitwiseAND(F.lit(_POSITION_MASK)),
        }
    ).drop("__id")
    return materialise(placed, name)


def row_number(df: DataFrame, groups: list[str], order_by: list[Column], out: str) -> DataFrame:
    """Exact ROW_NUMBER over groups of any size. ``order_by`` must end in a unique column.

    The rows are range-partitioned by group and order, so one large group spreads over many tasks.
    """
    placed = _ranges(df, [*[F.col(g).asc_nulls_last() for g in groups], *order_by], "row-number")
    sizes = placed.groupBy(*groups, "__part").agg(F.expr("count(*) AS __n"), F.expr("min(__pos) AS __first"))
    # Per group one row for each range it touches. Without groups: one row per range in all.
    before = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(g).alias(f"__{g}") for g in groups],
        F.col("__part").alias("____part"),
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
    )
    # Without groups there is one start per range, which broadcasts; with groups their bytes decide.
    starts = F.broadcast(starts) if not groups else materialise(starts, "starts")
    joined = placed.join(starts, _match(placed, starts, [*groups, "__part"]))
    return joined.select(*df.columns, F.expr(f"__pos + __shift + 1 AS {out}"))


def rank_in(df: DataFrame, groups: list[str], order_by: list[Column], out: str) -> DataFrame:
    """RANK inside groups whose size is bounded by what they are (subcells of a survey unit)."""
    return df.withColumn(out, F.rank().over(Window.partitionBy(*groups).orderBy(*order_by)))


def top_per_group(df: DataFrame, groups: list[str], order_by: list[Column], k: int = 1) -> DataFrame:
    """First ``k`` rows of every group; each task passes on at most ``k`` rows per group."""
    numbered = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*groups).orderBy(*order_by)))
    return numbered.filter(F.col("__rn") <= k).drop("__rn")


@dataclass(frozen=True)
class Criterion:
    """One percentile column: ``out`` ranks ``column`` over the whole relation."""

    out: str
    column: str | Column
    descending: bool = False
    nulls_last: bool = True

    @property
    def value(self) -> Column:
        return F.col(self.column) if isinstance(self.column, str) else self.column


def _broadcast_bytes(spark: SparkSession) -> int:
    """What the planner broadcasts at most."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)) if not text.startswith("-") else -1


def _common_type(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "double"
    return data_type.simpleString()


def percent_rank(df: DataFrame, criteria: list[Criterion]) -> DataFrame:
    """PERCENT_RANK over all rows for every criterion.

    The rows are reduced to (criterion, value, count) first; only those counts are range-partitioned
    and summed up in value order. Criteria with few values get their ranks by broadcast joins. For the
    others the rows are numbered, narrow rows (number, criterion, value) fetch the ranks, and the wide
    rows are joined with them once, however many criteria there are.
    """
    names = {c.out: f"__v{i}" for i, c in enumerate(criteria)}
    rows = df.withColumns({names[c.out]: c.value for c in criteria})
    kinds = {c.out: _common_type(rows.schema[names[c.out]].dataType) for c in criteria}
    rows = rows.withColumns({names[c.out]: F.col(names[c.out]).cast(kinds[c.out]) for c in criteria})
    below, sizes = _values_below(rows, names, kinds)
    most = _broadcast_bytes(df.sparkSession)
    few = [c for c in criteria if sizes.get(c.out, 0) <= most]
    many = [c for c in criteria if c not in few]
    # A single criterion with many values shuffles the wide rows once in any case.
    direct = few + many if len(many) == 1 else few
    for c in direct:
        lookup = _percents(below.filter(F.col("criterion") == c.out), c, kinds[c.out]).selectExpr(f"{_slot(kinds[c.out])} AS __value", c.out)
        rows = rows.join(F.broadcast(lookup) if c in few else lookup, F.col(names[c.out]).eqNullSafe(F.col("__value")), "left").drop("__value")
    if len(many) > 1:
        rows = _fetched(rows, below, many, names, kinds)
    return rows.select(*df.columns, *names)


def _values_below(rows: DataFrame, names: dict[str, str], kinds: dict[str, str]) -> tuple[DataFrame, dict[str, int]]:
    """For every criterion and value: its rows, the rows with smaller values, all rows, and NULL rows;
    and for every criterion the bytes of its values with their ranks.

    A value stands in the column of its type; the columns of the other types are NULL.
    """
    slots = {kind: _slot(kind) for kind in sorted(set(kinds.values()))}

    def value(out: str, kind: str) -> str:
        return f"{names[out] if kinds[out] == kind else f'CAST(NULL AS {kind})'} AS {slots[kind]}"

    pairs = [f"struct('{out}' AS criterion, {', '.join(value(out, k) for k in slots)})" for out in names]
    counts = rows.selectExpr(f"inline(array({', '.join(pairs)}))").groupBy("criterion", *slots.values()).agg(F.expr("count(*) AS n"))
    placed = _ranges(counts, [F.expr(c).asc_nulls_last() for c in ("criterion", *slots.values())], "value-counts")
    unknown = " AND ".join(f"{s} IS NULL" for s in slots.values())
    inside = "PARTITION BY criterion, __part ORDER BY __pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    running = placed.selectExpr("*", f"coalesce(sum(n) OVER ({inside}), 0L) AS __inside")
    # A row of a lookup holds the value and its rank.
    width = " + ".join(f"coalesce(octet_length({s}), 0)" if kind == "string" else "8" for kind, s in slots.items())
    sums = placed.groupBy("criterion", "__part").agg(
        F.expr("sum(n) AS __n"), F.expr(f"sum(IF({unknown}, n, 0L)) AS __nulls"), F.expr(f"sum(CAST({width} + 16 AS BIGINT)) AS __bytes")
    )
    before = "PARTITION BY criterion ORDER BY __part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    offsets = sums.selectExpr(
        "criterion",
        "__part",
        f"coalesce(sum(__n) OVER ({before}), 0L) AS __offset",
        "sum(__n) OVER (PARTITION BY criterion) AS total",
        "sum(__nulls) OVER (PARTITION BY criterion) AS nulls",
    )
    # One row per range and one more per criterion, however many values there are.
    below = running.join(F.broadcast(offsets), ["criterion", "__part"]).selectExpr(
        "criterion", *slots.values(), "n", "__inside + __offset AS below", "total", "nulls"
    )
    sizes = {r.criterion: r.n for r in sums.groupBy("criterion").agg(F.expr("sum(__bytes) AS n")).collect()}
    return below, sizes


def _slot(kind: str) -> str:
    return "value_" + "".join(ch if ch.isalnum() else "_" for ch in kind)


def _percents(values: DataFrame, criterion: Criterion, kind: str) -> DataFrame:
    """The values of one criterion with their percent rank."""
    known = "(total - nulls)"
    ahead = f"{known} - below - n" if criterion.descending else "below"
    if criterion.nulls_last:
        ranked = f"IF({_slot(kind)} IS NULL, {known}, {ahead})"
    else:
        ranked = f"IF({_slot(kind)} IS NULL, 0L, {ahead} + nulls)"
    return values.selectExpr("*", f"IF(total > 1, CAST({ranked} AS DOUBLE) / (total - 1), 0D) AS {criterion.out}")


def _fetched(rows: DataFrame, below: DataFrame, many: list[Criterion], names: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    slots = {kind: _slot(kind) for kind in sorted({kinds[c.out] for c in many})}
    ranked = [
        _percents(below.filter(F.col("criterion") == c.out), c, kinds[c.out]).selectExpr("criterion", *slots.values(), f"{c.out} AS percent") for c in many
    ]
    table = reduce(DataFrame.unionByName, ranked).selectExpr("criterion AS __criterion", *[f"{s} AS __{s}" for s in slots.values()], "percent")
    numbered = materialise(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered")

    def value(out: str, kind: str) -> str:
        return f"{names[out] if kinds[out] == kind else f'CAST(NULL AS {kind})'} AS {slots[kind]}"

    pairs = [f"struct('{c.out}' AS criterion, {', '.join(value(c.out, k) for k in slots)})" for c in many]
    narrow = numbered.selectExpr("__row", f"inline(array({', '.join(pairs)}))")
    # A frequent value is split by adaptive execution: both sides of the join are plain shuffles.
    found = narrow.join(table, _match(narrow, table, ["criterion", *slots.values()]))
    gathered = found.groupBy("__row").agg(*[F.expr(f"max(IF(criterion = '{c.out}', percent, NULL)) AS {c.out}") for c in many])
    return numbered.join(gathered, "__row")


def spaced_second(df: DataFrame, group: str, rank: str, line: str, position: str, gap: float) -> DataFrame:
    """First pick of every group, and the best other row on another line or at least ``gap`` away.

    ``rank`` is the place of each row inside its group. The rows are read once, and reduced to the best one of every
    group, line and position, which tasks combine before the shuffle: no other row can be a pick. The picks are found
    among those. The anchor has one row per group, and the second pick is an aggregate, so no group is gathered in one place.
    """
    best = df.groupBy(group, line, position).agg(F.min_by(F.struct(*df.columns), rank).alias("best")).select("best.*")
    best = materialise(best, "best")
    first = best.filter(F.col(rank) == 1)
    anchor = first.select(F.col(group).alias("__group"), F.col(line).alias("__line"), F.col(position).alias("__position"))
    others = best.filter(F.col(rank) > 1).join(anchor, F.col(group) == F.col("__group"))
    apart = (F.col(line) != F.col("__line")) | (F.abs(F.col(position) - F.col("__position")) >= F.lit(gap))
    chosen = others.filter(apart).groupBy(group).agg(F.min(rank).alias(rank))
    return first.unionByName(best.join(chosen, [group, rank], "left_semi"))
