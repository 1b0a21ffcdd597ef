"""Expressions on vectors, timestamps and path templates."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import col_

ARM_DIMS, ARM_JOINTS = 7, 6


def doubles(name: str) -> Column:
    return col_(name).cast("array<double>")


def scalar(name: str, array: bool) -> Column:
    """A number that some writers store as a list of one."""
    return F.element_at(col_(name), 1) if array else col_(name)


def exceeds(x: Column, limit: float) -> Column:
    """|x| > limit where NaN is never beyond a limit (Spark orders NaN last)."""
    return ~F.isnan(x) & (F.abs(x) > limit)


def reaches(x: Column, limit: float) -> Column:
    return ~F.isnan(x) & (F.abs(x) >= limit)


def frame_time(frame: Column, fps: float, mode: str = "rounded") -> Column:
    """Seconds of a frame: round5(float32(i) / fps), or float32(i) * float32(1 / fps) unrounded."""
    if mode == "rounded":
        return F.bround(frame.cast("float").cast("double") / F.lit(float(fps)), 5).cast("float")
    if mode == "float32":
        return (frame.cast("float") * F.lit(1.0 / fps).cast("float")).cast("float")
    raise ValueError(mode)


def negated_dims(joints: Sequence[int]) -> set[int]:
    """Dimensions whose sign turns: the chosen joints (1 to 6) of both arms."""
    if not joints or len(set(joints)) != len(joints) or not all(1 <= j <= ARM_JOINTS for j in joints):
        raise ValueError("joints to negate: 1 to 6, each once, one at least")
    return {j - 1 + arm for j in joints for arm in (0, ARM_DIMS)}


def mirror_vector(v: Column, joints: Sequence[int], checked: bool = True) -> Column:
    """arms swapped, chosen joints negated on both; another width than 14 is an error."""
    minus = negated_dims(joints)
    parts = [(-v[(i + ARM_DIMS) % 14]) if (i + ARM_DIMS) % 14 in minus else v[(i + ARM_DIMS) % 14] for i in range(14)]
    out = F.array(*parts)
    if not checked:
        return out
    return F.when(F.assert_true(F.size(v) == 14, "a vector of two arms has 14 numbers").isNull(), out)


def quat_to_rot6d(x: Column, y: Column, z: Column, w: Column) -> list[Column]:
    """First two columns of the rotation matrix of a quaternion, normalised first."""
    n = F.sqrt(x * x + y * y + z * z + w * w)
    x, y, z, w = x / n, y / n, z / n, w / n
    return [1 - 2 * (y * y + z * z), 2 * (x * y + z * w), 2 * (x * z - y * w), 2 * (x * y - z * w), 1 - 2 * (x * x + z * z), 2 * (y * z + x * w)]


FIELD = re.compile(r"\{(\w+)(?::0(\d+)d)?\}")


def format_path(template: str, chunks_size: int = 1000, episode: Column | None = None, video_key: Column | None = None) -> Column:
    """F8: a path template as a column; only relative paths below the root."""
    if template.startswith("/") or ".." in template.split("/"):
        raise ValueError("a path template is relative and stays below its root")
    episode = F.col("episode_index") if episode is None else episode
    known = {
        "episode_index": episode, "episode_chunk": F.floor(episode / chunks_size), "video_key": F.col("video_key") if video_key is None else video_key
    }
    fields = FIELD.findall(template)
    if unknown := [k for k, _ in fields if k not in known]:
        raise ValueError(f"unknown fields {unknown}")
    pattern = FIELD.sub(lambda m: "%s" if m[1] == "video_key" else f"%0{m[2]}d" if m[2] else "%d", template.replace("%", "%%"))
    return F.format_string(pattern, *(known[k] for k, _ in fields))
