"""Where end effectors dwell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kinematics import RIGHT_BASE, base_column, with_pose
from ..functions.vectors import doubles
from ..schema import STATE
from .quantiles import exact_quantiles

PLANES = (("XY", "x", "y"), ("XZ", "x", "z"), ("YZ", "y", "z"))


def forward_kinematics(
    frames: DataFrame, left: Sequence[int] = range(6), right: Sequence[int] = range(7, 13), right_base: Sequence[float] = RIGHT_BASE, **options
) -> DataFrame:
    """episode_index, frame_index, arm, x, y, z, roll, pitch, yaw: a row for each frame and arm."""
    extra = [c for c in ("timestamp",) if c in frames.columns]
    v, arms = doubles(STATE), []
    for arm, dims, base in (("left", left, (0.0,) * 6), ("right", right, right_base)):
        joints = F.array(*(F.get(v, F.lit(i)) for i in dims))
        arms.append(F.struct(F.lit(arm).alias("arm"), joints.alias("q"), base_column(base).alias("base")))
    both = frames.select("episode_index", "frame_index", *extra, F.explode(F.array(*arms)).alias("_a"))
    both = both.select("episode_index", "frame_index", *extra, "_a.arm", "_a.q", "_a.base")
    return with_pose(both, F.col("q"), F.col("base"), ["episode_index", "frame_index", *extra, "arm"], **options)


def finite() -> Column:
    return ~(F.isnan("x") | F.isnan("y") | F.isnan("z")) & (F.abs("x") < float("inf")) & (F.abs("y") < float("inf")) & (F.abs("z") < float("inf"))


def voxelize(poses: DataFrame, size: float) -> DataFrame:
    """Arm, ix, iy, iz, n and centres; positions that are not finite don't count."""
    cell = [F.floor(F.col(c) / size).cast("long").alias(f"i{c}") for c in "xyz"]
    counted = poses.filter(finite()).groupBy("arm", *cell).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("*", *(((F.col(f"i{c}") + 0.5) * size).alias(f"c{c}") for c in "xyz"))


def top_voxels(voxels: DataFrame, k: int = 200, fps: float = 30.0) -> DataFrame:
    """The k busiest voxels of each arm with dwell seconds and percent; ties in the order of the indices."""
    rank = F.row_number().over(Window.partitionBy("arm").orderBy(F.desc("n"), "ix", "iy", "iz"))
    top = voxels.withColumn("rank", rank).filter(F.col("rank") <= k)  # each task drops what can't be among the k
    totals = voxels.groupBy("arm").agg(F.sum("n").alias("_all"))
    return top.join(totals, "arm").withColumn("percent", 100 * F.col("n") / F.col("_all")).withColumn("dwell_s", F.col("n") / fps).select(
        *voxels.columns, "percent", "dwell_s", "rank"
    )


def position_summary(poses: DataFrame, voxels: DataFrame, fps: float = 30.0) -> DataFrame:
    """Per arm valid and invalid frames, measures of each axis, occupied voxels and the busiest one."""
    measures = []
    for c in "xyz":
        x = F.when(finite(), F.col(c))
        measures += [F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max"), F.avg(x).alias(f"{c}_mean"), F.stddev_pop(x).alias(f"{c}_std")]
    rows = poses.groupBy("arm").agg(F.count_if(finite()).alias("valid"), F.count_if(~finite()).alias("invalid"), *measures)
    busiest = F.max(F.struct("n", (-F.col("ix")).alias("x"), (-F.col("iy")).alias("y"), (-F.col("iz")).alias("z"))).alias("b")
    cells = voxels.groupBy("arm").agg(F.count(F.lit(1)).alias("voxels"), busiest).select(
        "arm", "voxels", F.col("b.n").alias("busiest_n"), (-F.col("b.x")).alias("busiest_ix"), (-F.col("b.y")).alias("busiest_iy"),
        (-F.col("b.z")).alias("busiest_iz"), (F.col("b.n") / fps).alias("busiest_s")
    )
    each = poses.filter(finite()).select(
        "arm", F.explode(F.array(*(F.struct(F.lit(c).alias("axis"), F.col(c).alias("v")) for c in "xyz"))).alias("a")
    ).select("arm", "a.*")
    quantiles = exact_quantiles(each, ["arm", "axis"], "v", [0.01, 0.05, 0.5, 0.95, 0.99])
    marks = [
        F.first(F.when(F.col("axis") == c, F.col("q")[i]), ignorenulls=True).alias(f"{c}_p{p}") for c in "xyz" for i,
        p in enumerate(("01", "05", "50", "95", "99"))
    ]
    named = quantiles.groupBy("arm").agg(*marks)
    return rows.join(F.broadcast(cells), "arm", "left").join(F.broadcast(named), "arm", "left").select(*rows.columns, *named.columns[1:], *cells.columns[1:])


def plane_density(poses: DataFrame, size: float, max_bins: int = 250) -> DataFrame:
    """2-D histograms (arm, plane, bx, by, n) on edges that both arms share."""
    rows = poses.filter(finite()).select("arm", "x", "y", "z")
    ends = rows.agg(*(F.floor(F.min(c) / size).alias(f"{c}0") for c in "xyz"), *(F.ceil(F.max(c) / size).alias(f"{c}1") for c in "xyz"))
    placed = rows.crossJoin(F.broadcast(ends))  # one row

    def place(c: str) -> Column:
        low, cells = F.col(f"{c}0") * size, F.greatest(F.col(f"{c}1") - F.col(f"{c}0"), F.lit(1))
        bins = F.least(cells, F.lit(max_bins))
        return F.least(F.floor((F.col(c) - low) / (cells * size / bins)), bins - 1)

    planes = F.array(*(F.struct(F.lit(p).alias("plane"), place(a).alias("bx"), place(b).alias("by")) for p, a, b in PLANES))
    return placed.select("arm", F.explode(planes).alias("p")).groupBy("arm", "p.plane", "p.bx", "p.by").agg(F.count(F.lit(1)).alias("n"))
