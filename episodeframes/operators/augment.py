"""Left-right mirroring of frames, statistics and cameras."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import ARM_DIMS, mirror_vector, negated_dims
from ..schema import ACTION, ACTION_KEYS, STATE, STATE_KEYS, Dataset, col_, resolve_key
from .select import rename_stats

# Camera keys that stand left and right of each other, and those that face forward.
CAMERA_SETS = (
    {
        "observation.images.top_head": "observation.images.top_head", "observation.images.hand_right": "observation.images.hand_left",
        "observation.images.hand_left": "observation.images.hand_right"
    },
    {
        "observation.images.cam_high": "observation.images.cam_high", "observation.images.cam_right_wrist": "observation.images.cam_left_wrist",
        "observation.images.cam_left_wrist": "observation.images.cam_right_wrist"
    },
)
#: Measures that come in pairs of a lower and an upper one.
PAIRS = (("min", "max"), ("q01", "q99"))


def mirror_measures(measures: Mapping[str, Column], joints: Sequence[int]) -> dict[str, Column]:
    """mean as the vector; std swaps arms only; of (min, max) and (q01, q99) negated dimensions become (-upper, -lower)."""
    minus, out = negated_dims(joints), {}
    for low, high in PAIRS:
        if (low in measures) != (high in measures):
            raise ValueError(f"{low} and {high} come together")
        if low in measures:
            for name, same, other in ((low, measures[low], measures[high]), (high, measures[high], measures[low])):
                turn = [(i + ARM_DIMS) % 14 for i in range(14)]
                out[name] = F.array(*((-other[t]) if t in minus else same[t] for t in turn))
    for name, m in measures.items():
        if name == "mean":
            out[name] = mirror_vector(m, joints, checked=False)
        elif name == "std":
            out[name] = F.array(*(m[(i + ARM_DIMS) % 14] for i in range(14)))
        elif name not in out:
            out[name] = m
    return out


def mirror_stats(stats: DataFrame, joints: Sequence[int], keys: Sequence[str] = (STATE, ACTION)) -> DataFrame:
    """F2 on episode statistics: the vectors' entries of the map."""

    def turned(k: Column, s: Column) -> Column:
        m = mirror_measures({n: s[n] for n in ("min", "max", "mean", "std")}, joints)
        return F.when(k.isin(list(keys)), F.struct(*(m[n].alias(n) for n in ("min", "max", "mean", "std")), s["count"].alias("count"))).otherwise(s)

    return stats.withColumn("stats", F.transform_values("stats", turned))


def mirror_norm_stats(norms: DataFrame, joints: Sequence[int], keys: Sequence[str] = (STATE, ACTION)) -> DataFrame:
    """F2 on norm statistics: rows (feature, mean, std, q01, q99) of arrays; other features, and other columns, stay."""
    names = [c for c in ("mean", "std", "q01", "q99") if c in norms.columns]
    turned = mirror_measures({n: F.col(n) for n in names}, joints)
    chosen = F.col("feature").isin(list(keys))
    return norms.withColumns({n: F.when(chosen, turned[n]).otherwise(F.col(n)) for n in names})


def camera_map(video_keys: Sequence[str]) -> dict[str, str]:
    """the keys' images. None or two fitting camera sets, or keys beyond the set, are errors."""
    if not video_keys:
        return {}
    fits = sorted(((len(set(video_keys) & set(s)), i) for i, s in enumerate(CAMERA_SETS)), reverse=True)
    if not fits[0][0] or (len(fits) > 1 and fits[0][0] == fits[1][0]):
        raise ValueError(f"no camera set, or more than one, fits {sorted(video_keys)}")
    found = CAMERA_SETS[fits[0][1]]
    if unknown := sorted(set(video_keys) - set(found)):
        raise ValueError(f"cameras without an image: {unknown}")
    return {k: found[k] for k in video_keys}


def mirror(ds: Dataset, joints: Sequence[int], state_key: str | None = None, action_key: str | None = None) -> Dataset:
    """Vectors, statistics and camera keys mirrored; frames don't move."""
    state, action = resolve_key(ds.frames.columns, state_key, STATE_KEYS, "error"), resolve_key(ds.frames.columns, action_key, ACTION_KEYS, "error")
    for key in (state, action):
        shape = (ds.info.features.get(key) or {}).get("shape")
        if shape is not None and list(shape) != [14]:
            raise ValueError(f"{key} has shape {shape}, not [14]")
    frames = ds.frames.select(*(mirror_vector(col_(c), joints).alias(c) if c in (state, action) else col_(c) for c in ds.frames.columns))
    cameras = camera_map(ds.info.video_keys())
    features = {cameras.get(k, k): v for k, v in ds.info.features.items()}
    swap = {k: v for s in CAMERA_SETS for k, v in s.items() if k != v}
    stats = ds.stats and rename_stats(mirror_stats(ds.stats, joints, (state, action)), swap)
    return ds.with_(frames=frames, info=replace(ds.info, features=features), stats=stats)
