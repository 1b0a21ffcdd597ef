"""Exact quantiles of groups of any size: sketches bracket the wanted ranks, counts find them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import MOST_SMALL

#: Rows of a group up to which its values are counted in one aggregation buffer (16 MB); larger groups are bracketed.
BUFFERED = 1 << 20
#: Sketches are asked for the ranks this far (of all rows) below and above each wanted one.
MARGIN, ACCURACY = 0.0005, 10_000
#: Rows of a cell, which one task sorts, and cells that a bracket can have.
CELL_ROWS, MOST_CELLS = 100_000, 65_536


def exact_quantiles(rows: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float], few: bool | None = True, largest: int | None = None) -> DataFrame:
    """(by..., q): the quantiles of each group as an array, interpolated linearly; nulls don't count, NaN is the largest.

    Groups without a value, or with a null among ``by``, have no row. ``largest`` may bound the rows of a group; without
    it they are counted first. What is known of each group (brackets, sums) is broadcast if the groups are ``few`` by their
    kind (dimensions, axes, signals), or by their number if that is None, and joined by shuffle otherwise.
    """
    by = list(by)
    plain = rows.select(*by, F.col(value).cast("double").alias("_x")).filter(" and ".join(f"`{c}` is not null" for c in [*by, "_x"]))
    if largest is None or few is None:
        counts = plain.groupBy(*by).agg(F.count(F.lit(1)).alias("n")) if by else plain.agg(F.count(F.lit(1)).alias("n"))
        most, groups = counts.agg(F.max("n"), F.count(F.lit(1))).first()
        largest, few = largest or most or 0, groups * 100 <= MOST_SMALL if few is None else few
    if largest <= BUFFERED:
        exact = F.percentile("_x", F.array(*(F.lit(float(p)) for p in probabilities))).alias("q")
        found = plain.groupBy(*by).agg(exact) if by else plain.agg(exact)
        return found.filter("q is not null")
    return bracketed(plain, by, probabilities, few)


def bracketed(plain: DataFrame, by: list[str], probabilities: Sequence[float], few: bool) -> DataFrame:
    """Ranks by counting, in three passes over ``plain`` (by..., _x), none of which moves it whole.

    A sketch gives edges closely around each wanted rank. The rows between edges are counted, which shows the bracket of
    every rank for certain, however the sketch erred. Only rows of brackets with a wanted rank are looked at again: equal
    values are counted, cells of equal width that follow the number of rows are summed, and the values of the cells with a
    wanted rank alone are put in order.
    """
    by = by or ["_all_rows"]
    plain = plain if "_all_rows" not in by else plain.withColumn("_all_rows", F.lit(0))

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    marks = sorted({min(1.0, max(0.0, p + m)) for p in probabilities for m in (-MARGIN, MARGIN)})
    edges = plain.groupBy(*by).agg(F.percentile_approx("_x", F.array(*map(F.lit, marks)), F.lit(ACCURACY)).alias("_edges"), F.count(F.lit(1)).alias("_all"))
    above = [(F.col("_x") > F.col("_edges")[i]).cast("int") for i in range(len(marks))]
    bracket = sum(above[1:], above[0]).alias("_bracket")
    placed = plain.join(side(edges.select(*by, "_edges")), by).select(*by, "_x", bracket)
    sums = placed.groupBy(*by, "_bracket").agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"))
    earlier = Window.partitionBy(*by).orderBy("_bracket").rowsBetween(Window.unboundedPreceding, -1)
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(p * (F.col("_all") - 1)), F.ceil(p * (F.col("_all") - 1))) for p in map(F.lit, map(float, probabilities))))))
    based = sums.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(side(edges.select(*by, "_all")), by).withColumn("_ranks", ranks)
    inside = F.filter("_ranks", lambda r: (r >= F.col("_base")) & (r < F.col("_base") + F.col("_n"))).alias("_ranks")
    cells = F.least(F.lit(MOST_CELLS), F.ceil(F.col("_n") / CELL_ROWS)).alias("_cells")
    wanted = based.select(*by, "_bracket", "_low", "_high", "_base", inside, cells).filter(F.size("_ranks") > 0)
    # the rows of those brackets: equal values counted, then cells of equal width
    width = (F.col("_high") - F.col("_low")) / F.col("_cells")
    even = F.least(F.floor((F.col("_x") - F.col("_low")) / width), F.col("_cells") - 1)
    cell = F.when((width > 0) & (width < float("inf")), even).otherwise(0).cast("long").alias("_cell")
    near = placed.join(side(wanted.select(*by, "_bracket", "_low", "_high", "_cells")), [*by, "_bracket"]).select(*by, "_bracket", "_x", cell)
    counted = near.groupBy(*by, "_bracket", "_cell", "_x").agg(F.count(F.lit(1)).alias("_n"))
    summed = counted.groupBy(*by, "_bracket", "_cell").agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy(*by, "_bracket").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    within = summed.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(side(wanted.select(*by, "_bracket", "_base", "_ranks")), [*by, "_bracket"])
    start = F.col("_base") + F.col("_before")
    within = within.select(*by, "_bracket", "_cell", start.alias("_start"), F.filter("_ranks", lambda r: (r >= start) & (r < start + F.col("_n"))).alias("_ranks"))
    chosen = counted.join(side(within.filter(F.size("_ranks") > 0)), [*by, "_bracket", "_cell"])
    upto = Window.partitionBy(*by, "_bracket", "_cell").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = chosen.withColumn("_end", F.col("_start") + F.sum("_n").over(upto))
    hit = F.filter("_ranks", lambda r: (r >= F.col("_end") - F.col("_n")) & (r < F.col("_end")))
    values = ordered.select(*by, "_x", F.explode(hit).alias("_rank"))
    found = values.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at")).join(side(edges.select(*by, "_all")), by)
    parts = []
    for p in map(float, probabilities):
        at = F.lit(p) * (F.col("_all") - 1)
        a, b, share = F.col("_at")[F.floor(at)], F.col("_at")[F.ceil(at)], at - F.floor(at)
        parts.append(F.when((share == 0) | (a == b), a).otherwise((1 - share) * a + share * b))
    return found.select(*(c for c in by if c != "_all_rows"), F.array(*parts).alias("q"))
