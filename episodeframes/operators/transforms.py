"""force deltas and rotation states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import doubles, quat_to_rot6d
from ..schema import ACTION, STATE, col_, dims_of

# Names of the force dimensions, and of the pose dimensions with their quaternion.
FORCE_NAMES = tuple(f"{side}_wrench.force.{axis}" for side in ("left", "right") for axis in "xyz")


def force_delta(
    frames: DataFrame, names: Sequence[str], columns: Sequence[str] = (STATE, ACTION), action_names: Sequence[str] | None = None
) -> DataFrame:
    """forces become differences from the state's forces in the episode's first frame, in single precision."""
    w = Window.partitionBy("episode_index").orderBy("frame_index")
    base_dims = dims_of(names, FORCE_NAMES)
    df = frames.withColumn("_base", F.first(F.array(*(col_(STATE)[i].cast("float") for i in base_dims))).over(w))
    for c in columns:
        at = dims_of(action_names if c == ACTION and action_names else names, FORCE_NAMES)
        # position of each dimension in the base, -1 for those that stay
        place = F.array(*(F.lit(at.index(i) if i in at else -1) for i in range(len(action_names if c == ACTION and action_names else names))))
        moved = F.transform(
            F.arrays_zip(col_(c).cast("array<float>").alias("x"), place.alias("k")),
            lambda z: F.when(z["k"] >= 0, (z["x"] - F.get(F.col("_base"), z["k"])).cast("float")).otherwise(z["x"])
        )
        df = df.withColumn(c, moved)
    return df.drop("_base")


def force_violations(frames: DataFrame, names: Sequence[str], atol: float = 1e-5) -> DataFrame:
    """First frames whose state forces are not zero, and frames with a force that is not finite."""
    w = Window.partitionBy("episode_index").orderBy("frame_index")
    forces = F.array(*(col_(STATE)[i].cast("double") for i in dims_of(names, FORCE_NAMES)))
    rule = F.when(
        F.exists(forces, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), "not finite"
    ).when((F.row_number().over(w) == 1) & F.exists(forces, lambda x: F.abs(x) > atol), "first frame")
    return frames.withColumn("rule", rule).filter("rule is not null").select("episode_index", "frame_index", "rule")


def quat_state_to_rot6d(
    frames: DataFrame, positions: Sequence[int], quaternion: Sequence[int], gripper: int, state_key: str = STATE, least_norm: float = 1e-8
) -> DataFrame:
    """the state becomes [x, y, z, first and second column of the rotation, gripper]; a quaternion that is not finite or
    has no norm is an error."""
    v = doubles(state_key)
    q = [v[i] for i in quaternion]
    norm = F.sqrt(sum((x * x for x in q[1:]), q[0] * q[0]))
    sound = F.assert_true(~F.isnan(norm) & (norm < float("inf")) & (norm >= least_norm), F.lit("a quaternion without a direction"))
    out = F.array(*(v[i] for i in positions), *quat_to_rot6d(*q), v[gripper])
    return frames.withColumn(state_key, F.when(sound.isNull(), out).cast("array<float>"))
