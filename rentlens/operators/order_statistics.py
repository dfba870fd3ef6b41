"""Exact order statistics of groups of any size, from one range exchange.

The source is read once. Its distinct values are counted per group; the counts are dealt into partitions by (group, value)
ranges of about equal size and stored with the number of their partition. Everything else works on that reduced table: the
counts of each partition are summed, the few sums of a group become the rank at which each partition begins, and a wanted rank
is looked for in the one partition that holds it. A group of any size is spread over partitions, whatever its values are.

Aggregates that are wanted beside the quantiles come from the same pass over the source, as further grouping sets.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

VALUES, WHOLE, ENTITIES = 0, 1, 2  # what a stored row is: a counted value, a group's aggregates, an entity of a group


def same_group(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equal keys of two aliased tables; NULL matches NULL."""
    return reduce(lambda a, k: a & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")), keys, F.lit(True))


class ValueCounts:
    """The stored value counts of a column per group, beside aggregates and distinct entities of the groups.

    ``distinct`` names columns and what they count: a group's number of different values that are not NULL.
    """

    def __init__(self, df: DataFrame, value: str, by: Sequence[str] = (), measures: Sequence[Column] = (), distinct: Mapping[str, str] | None = None):
        self.by, self.distinct = list(by), dict(distinct or {})
        number = F.col(f"`{value}`").cast("double")
        rows = df.withColumn("_v", F.when(~F.isnan(number), number))
        entities = [f"_e{i}" for i in range(len(self.distinct))]
        rows = rows.withColumns({e: F.col(f"`{c}`") for e, c in zip(entities, self.distinct.values(), strict=True)})
        keys = [f"`{k}`" for k in self.by]
        if measures or entities:
            sets = [[*keys, "_v"], keys, *[[*keys, e] for e in entities]]
            # Bits of the grouping id, from the right: entities from the last to the first, then the value.
            total = rows.groupingSets(sets, *keys, "_v", *entities).agg(F.count("*").alias("_n"), F.grouping_id().alias("_id"), *measures)
            low = (1 << len(entities)) - 1
            kind = F.when(F.col("_id") == low, VALUES).when(F.col("_id") == 2 * low + 1, WHOLE).otherwise(ENTITIES)
            total = total.withColumn("_kind", kind)
            present = reduce(lambda a, e: a | F.col(e).isNotNull(), entities, F.lit(False))
            total = total.where((F.col("_kind") == WHOLE) | (F.col("_kind") == VALUES) & F.col("_v").isNotNull() | (F.col("_kind") == ENTITIES) & present)
            total = total.withColumn("_entity", F.when(F.col("_kind") == ENTITIES, sum(F.when(F.col(e).isNotNull(), F.lit(i)).otherwise(F.lit(0)) for i, e in enumerate(entities))) if entities else F.lit(None).cast("int"))
            total = total.drop("_id", *entities)
        else:
            total = rows.where("_v is not null").groupBy(*keys, "_v").agg(F.count("*").alias("_n")).withColumns({"_kind": F.lit(VALUES), "_entity": F.lit(None).cast("int")})
        dealt = total.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id())
        self.measures = [c for c in dealt.columns if c not in {*self.by, "_v", "_n", "_kind", "_entity", "_part"}]
        self.table = stored(dealt, "value-counts")

    def values(self) -> DataFrame:
        """The groups' values ``_v`` and their counts ``_n``."""
        return self.table.where(F.col("_kind") == VALUES).select(*[f"`{k}`" for k in self.by], "_v", "_n", "_part")

    def summary(self, points: Mapping[str, float], method: str = "linear", size: str = "n") -> DataFrame:
        """One row per group: the aggregates, the distinct counts, the number of known values (``size``), and a column per named point.

        ``linear`` interpolates between neighbours, ``lower`` takes the smallest value whose cumulative share reaches the
        point. Groups without known values have NULLs if there are aggregates, else no row.
        """
        if method not in ("linear", "lower"):
            raise ValueError("method must be 'linear' or 'lower'")
        keys = [f"`{k}`" for k in self.by]
        found = self._ranked(points, method)
        if self.measures or self.distinct:
            whole = self.table.where(F.col("_kind") == WHOLE).select(*keys, *[f"`{m}`" for m in self.measures])
            found = found.unionByName(whole, allowMissingColumns=True)
        for i, name in enumerate(self.distinct):
            counted = self.table.where((F.col("_kind") == ENTITIES) & (F.col("_entity") == i)).groupBy(*keys).agg(F.count("*").alias(f"_d{i}"))
            found = found.unionByName(counted, allowMissingColumns=True)
        found = found.repartition(*keys) if keys else found.coalesce(1)
        place = Window.partitionBy(*keys, "_slot").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        found = found.withColumn("_hit", F.col("_before") + F.sum("_n").over(place) >= F.col("_rank"))

        def pick(slot: str) -> Column:
            return F.min(F.when((F.col("_slot") == slot) & F.col("_hit"), F.col("_v")))

        total = F.max("_total")
        columns = [F.first(f"`{m}`", ignorenulls=True).alias(m) for m in self.measures]
        columns += [F.coalesce(F.max(f"_d{i}"), F.lit(0)).alias(name) for i, name in enumerate(self.distinct)]
        columns.append(total.alias(size))
        for name, p in points.items():
            low = pick(f"{name}__low")
            if method == "linear":
                position = F.lit(float(p)) * (total - 1)
                low = low + (pick(f"{name}__high") - low) * (position - F.floor(position))
            columns.append(low.alias(name))
        out = found.groupBy(*keys).agg(*columns)
        # Without groups an aggregation always has a row; an empty source has none.
        return out if self.by or self.measures or self.distinct else out.where(F.col(size).isNotNull())

    def _ranked(self, points: Mapping[str, float], method: str) -> DataFrame:
        """The counted values of the partitions that hold a wanted rank, with the rank and what lies before the partition."""
        keys = [f"`{k}`" for k in self.by]
        counts = self.values()
        parts = counts.groupBy(*keys, "_part").agg(F.sum("_n").alias("_here"))
        through = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
        parts = parts.withColumns({"_upto": F.sum("_here").over(through), "_total": F.sum("_here").over(Window.partitionBy(*keys))})
        wanted = []
        for name, p in points.items():
            if method == "linear":
                position = F.lit(float(p)) * (F.col("_total") - 1)
                ranks = [(f"{name}__low", F.floor(position) + 1), (f"{name}__high", F.ceil(position) + 1)]
            else:
                ranks = [(f"{name}__low", F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.col("_total"))))]
            wanted += [F.struct(F.lit(n).alias("slot"), r.cast("bigint").alias("rank")) for n, r in ranks]
        before = F.col("_upto") - F.col("_here")
        targets = (
            parts.withColumn("_want", F.explode(F.array(*wanted)))
            .where((F.col("_want.rank") <= F.col("_upto")) & (F.col("_want.rank") > before))
            .select(*keys, "_part", "_total", F.col("_want.slot").alias("_slot"), F.col("_want.rank").alias("_rank"), before.alias("_before"))
        )
        joined = counts.alias("c").join(targets.alias("t"), same_group("c", "t", [*self.by, "_part"]))
        return joined.select(*[f"c.`{k}`" for k in self.by], "c._v", "c._n", "t._total", "t._slot", "t._rank", "t._before")
