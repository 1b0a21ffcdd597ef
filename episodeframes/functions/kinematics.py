"""forward kinematics of a six-joint arm, as expressions on columns."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Modified Denavit-Hartenberg parameters of the arm (metres, degrees).
LINK_A = (0.0, 0.0, 0.28503, -0.02198, 0.0, 0.0)
LINK_ALPHA_DEG = (0.0, -90.0, 0.0, 90.0, -90.0, 90.0)
LINK_D = (0.123, 0.0, 0.0, 0.25075, 0.0, 0.091)
OFFSET_DEG = (0.0, -172.22, -102.78, 0.0, 0.0, 0.0)
NO_OFFSET_DEG = (0.0, -174.22, -100.78, 0.0, 0.0, 0.0)
#: Fixed value: base of the right arm relative to the left one.
RIGHT_BASE = (0.0, -0.71, 0.0, 0.0, 0.0, 0.0)
#: Fixed value: how near to 1 the sine of the pitch counts as straight up or down.
GIMBAL = 1e-4

AXES = ("x", "y", "z", "p")
POSE = ("x", "y", "z", "roll", "pitch", "yaw")


def links(dh_offset: bool = True) -> list[dict[str, float]]:
    """Constants of each link: length, offset, cosine and sine of its twist, and the zero of its joint."""
    zeros = OFFSET_DEG if dh_offset else NO_OFFSET_DEG
    rows = zip(LINK_A, LINK_D, LINK_ALPHA_DEG, zeros, strict=True)
    return [{"a": a, "d": d, "ca": math.cos(math.radians(t)), "sa": math.sin(math.radians(t)), "zero": math.radians(z)} for a, d, t, z in rows]


def base_frame(pose: Sequence[float]) -> dict[str, list[float]]:
    """Axes and origin (p) of a base given in metres and degrees: roll, then pitch, then yaw about fixed axes."""
    axes = np.eye(3)
    for axis, degrees in zip((0, 1, 2), pose[3:], strict=True):
        i, j = (axis + 1) % 3, (axis + 2) % 3
        c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
        turn = np.eye(3)
        turn[[i, i, j, j], [i, j, i, j]] = c, -s, s, c
        axes = turn @ axes
    return {"x": axes[:, 0].tolist(), "y": axes[:, 1].tolist(), "z": axes[:, 2].tolist(), "p": [float(v) for v in pose[:3]]}


def turned(f: dict[str, list[Column]], k: Mapping[str, Column | float]) -> dict[str, list[Column]]:
    """A frame carried over a link: y and z turn about x by the twist, it moves along x and the new z, x and y turn by the joint."""
    out: dict[str, list[Column]] = {a: [] for a in AXES}
    for x, y, z, p in zip(*(f[a] for a in AXES), strict=True):
        side, up = y * k["ca"] + z * k["sa"], z * k["ca"] - y * k["sa"]
        out["x"].append(x * k["c"] + side * k["s"])
        out["y"].append(side * k["c"] - x * k["s"])
        out["z"].append(up)
        out["p"].append(p + x * k["a"] + up * k["d"])
    return out


def pose_columns(f: dict[str, list[Column]], tcp_offset: Sequence[float]) -> list[Column]:
    """x, y, z, roll, pitch, yaw of a frame."""
    place = [f["p"][i] + sum((f[a][i] * float(t) for a, t in zip("xyz", tcp_offset, strict=True)), F.lit(0.0)) for i in range(3)]
    # the x axis points by yaw and pitch. Where it stands upright, yaw is free: it is 0, and the roll is what y shows
    nose = f["x"][2]
    upright, sign = F.abs(nose) > 1 - GIMBAL, -F.signum(nose)
    roll = F.when(upright, F.atan2(sign * f["y"][0], f["y"][1])).otherwise(F.atan2(f["y"][2], f["z"][2]))
    pitch = F.when(upright, sign * (math.pi / 2)).otherwise(F.atan2(-nose, F.hypot(f["x"][0], f["x"][1])))
    yaw = F.when(upright, F.lit(0.0)).otherwise(F.atan2(f["x"][1], f["x"][0]))
    return [v.alias(n) for v, n in zip([*place, roll, pitch, yaw], POSE, strict=True)]


def parts(frame: Column) -> dict[str, list[Column]]:
    return {a: [frame[a][i] for i in range(3)] for a in AXES}


def base_column(pose: Sequence[float]) -> Column:
    base = base_frame(pose)
    return F.struct(*(F.array(*map(F.lit, base[a])).alias(a) for a in AXES))


def pose_of(
    joints: Column, dh_offset: bool = True, tcp_offset: Sequence[float] = (0, 0, 0), base_pose: Sequence[float] = (0, 0, 0, 0, 0, 0)
) -> Column:
    """struct(x, y, z, roll, pitch, yaw) in metres and radians of an array of six joint angles; a null or another width is an error.

    One expression for use anywhere; it folds over the links, which Spark interprets. Over tables take ``with_pose``.
    """
    constants = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in link.items())) for link in links(dh_offset)))
    checked = F.when(F.assert_true(F.coalesce(F.size(joints) == 6, F.lit(False)), F.lit("six joint angles a row")).isNull(), joints)

    def step(q: Column, c: Column) -> Column:
        angle = q + c["zero"]
        return F.struct(F.cos(angle).alias("c"), F.sin(angle).alias("s"), *(c[k].alias(k) for k in ("a", "d", "ca", "sa")))

    def carried(f: Column, k: Column) -> Column:
        out = turned(parts(f), {n: k[n] for n in ("c", "s", "a", "d", "ca", "sa")})
        return F.struct(*(F.array(*out[a]).alias(a) for a in AXES))

    return F.aggregate(F.zip_with(checked, constants, step), base_column(base_pose), carried, lambda f: F.struct(*pose_columns(parts(f), tcp_offset)))


def with_pose(
    rows: DataFrame, joints: Column, base: Column, kept: Sequence[str], dh_offset: bool = True, tcp_offset: Sequence[float] = (0, 0, 0)
) -> DataFrame:
    """The columns ``kept``, then x, y, z, roll, pitch, yaw of six joint angles in the frame of ``base`` (a ``base_column``).

    A projection for each link over plain columns, so all of it stays in generated code. A null angle gives a null pose.
    """
    keep = [F.col(c).alias(f"_kept{i}") for i, c in enumerate(kept)]  # names that can't meet those of the frame
    angles = [joints[i].alias(f"_q{i}") for i in range(6)]
    names = {a: [f"_{a}{i}" for i in range(3)] for a in AXES}

    def named(f: dict[str, list[Column]]) -> list[Column]:
        return [v.alias(n) for a in AXES for v, n in zip(f[a], names[a], strict=True)]

    now = {a: [F.col(n) for n in names[a]] for a in AXES}
    rows = rows.select(*keep, *angles, *named(parts(base)))
    for i, link in enumerate(links(dh_offset)):
        angle = F.col(f"_q{i}") + link["zero"]
        rest = [f"_kept{j}" for j in range(len(kept))] + [f"_q{j}" for j in range(i + 1, 6)]
        rows = rows.select(*rest, *named(turned(now, link | {"c": F.cos(angle), "s": F.sin(angle)})))
    return rows.select(*(F.col(f"_kept{i}").alias(c) for i, c in enumerate(kept)), *pose_columns(now, tcp_offset))
