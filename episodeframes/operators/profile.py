"""Distributions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import doubles, exceeds
from ..schema import ACTION, STATE, col_, small
from .quantiles import exact_quantiles

#: Categories of dimension names, the first that fits counts (prefixes, or whole names).
CATEGORIES = (
    ("Left Arm", ("left_",), ()),
    ("Right Arm", ("right_",), ()),
    ("Trunk Joints", (), ("head_joint", "lifter_joint", "neck_joint", "waist_joint")),
    ("Chassis Pose", ("chassis.pose.",), ()),
    ("Control Flags", ("chassis.remote_",), ()),
)


def dimension_names(names: Sequence[str], width: int) -> list[str]:
    """The declared names, or dim_i where their number is not the width."""
    return list(names) if len(names) == width else [f"dim_{i}" for i in range(width)]


def _few_values(width: int, most: int):
    """Rows (vector): for each place the values of the task with their counts, or one row ``over`` where there are more than
    ``most`` numbers; nulls and NaN are always counted. What a task holds is bounded by the width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict | None] = [{} for _ in range(width)]
        extra = np.zeros((width, 2), np.int64)  # nulls and NaN
        for batch in batches:
            sizes = batch.column(0).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat, starts = batch.column(0).flatten(), np.cumsum(sizes) - sizes
            null, x = flat.is_null().to_numpy(zero_copy_only=False), flat.fill_null(0.0).to_numpy()
            for d in range(width):
                at = starts[sizes > d] + d
                extra[d] += null[at].sum(), np.isnan(x[at]).sum()
                if held[d] is None:
                    continue
                values, n = np.unique(x[at][~null[at] & ~np.isnan(x[at])], return_counts=True)
                if len(values) <= most:
                    for v, k in zip((values + 0.0).tolist(), n.tolist(), strict=True):
                        held[d][v] = held[d].get(v, 0) + k
                if len(values) > most or len(held[d]) > most:
                    held[d] = None
        rows = [(d, v, n, False) for d, h in enumerate(held) if h for v, n in h.items()] + [(d, None, 0, True) for d, h in enumerate(held) if h is None]
        rows += [(d, v, int(n), False) for d in range(width) for v, n in zip((None, float("nan")), extra[d], strict=True) if n]
        if rows:
            d, v, n, over = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int32()), pa.array(v, pa.float64(), from_pandas=False), pa.array(n, pa.int64()), pa.array(over)], ["dim", "value", "n", "over"])

    return run


def few_values(frames: DataFrame, feature: str, width: int, most: int) -> DataFrame:
    """(dim, value, n) of the dimensions with at most ``most`` numbers, exactly; nulls and NaN are values that don't count
    against that. All dimensions in one pass; a task sends at most ``most`` + 2 rows for each."""
    rows = frames.select(doubles(feature).alias("v")).mapInArrow(_few_values(width, most), "dim int, value double, n long, over boolean")
    counted = rows.groupBy("dim", "value").agg(F.sum("n").alias("n"), F.bool_or("over").alias("over"))
    number = F.col("value").isNotNull() & ~F.isnan("value")
    w = Window.partitionBy("dim")
    few = counted.withColumn("numbers", F.count_if(number).over(w)).withColumn("gone", F.bool_or("over").over(w))
    return few.filter((F.col("numbers") <= most) & ~F.col("gone")).select("dim", "value", "n")


def dimension_summary(frames: DataFrame, feature: str, names: Sequence[str], width: int, limit: float = math.pi, max_unique: int = 5) -> DataFrame:
    """Per dimension n, min, max, quartiles, whether it has at most ``max_unique`` numbers (``discrete``, exact; also under
    its older name, ``maybe_discrete``), degrees of joints, and whether a joint leaves the limit. A feature whose vectors have unlike widths is skipped: its one row, of
    dimension -1, says so in its name.

    Measures of all dimensions are columns of one aggregation; the quartiles take a row for each value.
    """
    names, v = dimension_names(names, width), doubles(feature)
    measures = []
    for i in range(width):
        x = F.get(v, F.lit(i))
        number = F.when(~F.isnan(x), x)
        measures.append(
            F.struct(
                F.lit(i).alias("dim"), F.lit(names[i]).alias("name"), F.lit(
                    names[i].endswith("_joint")
                ).alias("joint"), F.count(x).alias("n"), F.min(number).alias("min"), F.max(number).alias("max"),
                F.coalesce(F.bool_or(exceeds(x, limit)), F.lit(False)).alias("beyond"),
            )
        )
    values = frames.select(F.posexplode(v).alias("dim", "x")).filter(F.col("dim") < width).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    quartiles = exact_quantiles(values, ["dim"], "x", [0.25, 0.5, 0.75])
    discrete = few_values(frames, feature, width, max_unique).filter("value is not null and not isnan(value)").select("dim").distinct()
    sizes = F.size(col_(feature))
    whole = frames.agg(F.array(*measures).alias("m"), F.min(sizes).alias("_low"), F.max(sizes).alias("_high"))
    skipped = F.array(F.struct(
        F.lit(-1).alias("dim"), F.format_string("skipped: widths from %d to %d", "_low", "_high").alias("name"), F.lit(False).alias("joint"), F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max"), F.lit(False).alias("beyond"),
    ))
    df = whole.select(F.explode(F.when(F.col("_low") < F.col("_high"), skipped).otherwise(F.col("m"))).alias("m")).select("m.*")
    df = df.join(F.broadcast(quartiles), "dim", "left").join(F.broadcast(discrete.withColumn("_few", F.lit(True))), "dim", "left")
    few = F.coalesce("_few", F.lit(False))
    degrees = [F.when(F.col("joint"), F.degrees(c)).alias(f"{c}_deg") for c in ("min", "max")]
    return df.select(
        F.lit(feature).alias("feature"), "dim", "name", "joint", "n", "min", "max", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"), *degrees, few.alias("discrete"), few.alias("maybe_discrete"), (F.col("joint") & F.col("beyond")).alias("abnormal")
    )


def discrete_shares(frames: DataFrame, feature: str, width: int, max_unique: int = 5) -> DataFrame:
    """Value, count and percent for dimensions with at most max_unique values, nulls and NaN among them."""
    w = Window.partitionBy("dim")
    rows = few_values(frames, feature, width, max_unique).withColumn("values", F.count(F.lit(1)).over(w))
    return rows.withColumn("percent", 100 * F.col("n") / F.sum("n").over(w)).filter(F.col("values") <= max_unique).select("dim", "value", "n", "percent")


def out_of_range_episodes(frames: DataFrame, limit: float = math.pi, features: Sequence[str] = (STATE, ACTION)) -> DataFrame:
    """Episodes in which any dimension of state or action leaves the limit."""
    beyond = F.lit(False)
    for f in features:
        beyond = beyond | F.coalesce(F.exists(doubles(f), lambda x: exceeds(x, limit)), F.lit(False))
    return frames.groupBy("episode_index").agg(F.bool_or(beyond).alias("abnormal")).filter("abnormal").select("episode_index")


def out_of_range_share(frames: DataFrame, limit: float = math.pi) -> DataFrame:
    """Episodes, abnormal ones and their percentage."""
    each = frames.select("episode_index").distinct().join(out_of_range_episodes(frames, limit).withColumn("bad", F.lit(1)), "episode_index", "left")
    return each.agg(
        F.count(F.lit(1)).alias("episodes"), F.count("bad").alias("abnormal")
    ).withColumn("percent", 100 * F.col("abnormal") / F.col("episodes"))


def episode_length_summary(episodes: DataFrame) -> DataFrame:
    """Count, min, max and quartiles of lengths."""
    quartiles = exact_quantiles(episodes, [], "length", [0.25, 0.5, 0.75])
    rows = episodes.agg(F.count(F.lit(1)).alias("episodes"), F.min("length").alias("min"), F.max("length").alias("max"))
    return rows.join(F.broadcast(quartiles), how="left").select(
        "episodes", "min", "max", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75")
    )


def classify_dimensions(names: Sequence[str], rules: Sequence[tuple] = CATEGORIES, other: str = "Other") -> list[tuple[int, str, str]]:
    """(dim, name, category)."""
    return [(i, n, next((c for c, prefixes, whole in rules if n.startswith(tuple(prefixes)) or n in whole), other)) for i, n in enumerate(names)]


def sqrt_bins(n: int, low: int = 20, high: int = 120) -> int:
    return min(high, max(low, int(math.sqrt(n))))


def histogram(df: DataFrame, value: str, by: Sequence[str], bins: int | Callable[[int], int] | str = "sqrt") -> DataFrame:
    """(by..., bin, low, high, n): equal widths between the group's extremes, the last bin closed on the right."""
    rows = df.select(*by, F.col(value).cast("double").alias("_x")).filter("_x is not null and not isnan(_x)")
    count = F.least(F.lit(120), F.greatest(F.lit(20), F.floor(F.sqrt(F.count(F.lit(1)))))) if bins == "sqrt" else F.lit(int(bins))
    edges = rows.groupBy(*by).agg(F.min("_x").alias("_low"), F.max("_x").alias("_high"), count.cast("int").alias("_bins"))
    # as numpy: a group of one value gets a width of one around it
    edges = edges.withColumn("_flat", F.col("_low") == F.col("_high")).withColumn("_low", F.when(F.col("_flat"), F.col("_low") - 0.5).otherwise(F.col("_low"))).withColumn(
        "_high", F.when(F.col("_flat"), F.col("_high") + 0.5).otherwise(F.col("_high"))
    )
    width = (F.col("_high") - F.col("_low")) / F.col("_bins")
    placed = rows.join(small(edges), list(by)).withColumn("bin", F.least(F.floor((F.col("_x") - F.col("_low")) / width), F.col("_bins") - 1).cast("int"))
    return placed.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first(F.col("_low") + F.col("bin") * width).alias("low"),
        F.first(F.col("_low") + (F.col("bin") + 1) * width).alias("high")
    )
