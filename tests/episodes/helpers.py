"""Small datasets with hand-computed answers, and numpy restatements used as oracles."""

import numpy as np

from episodeframes.schema import ACTION, STATE, Dataset, DatasetInfo

# Lengths, task numbers and names of the fixture that FIXTURES.md describes for range extraction.
LENGTHS, TASKS, NAMES = (2, 3, 2, 2, 1), (0, 2, 2, 1, 0), ("alpha", "beta", "gamma")


def range_dataset(spark) -> Dataset:
    """Five episodes of lengths 2, 3, 2, 2, 1; state e + 1, action e + 10."""
    rows, index = [], 0
    for e, (n, t) in enumerate(zip(LENGTHS, TASKS)):
        for i in range(n):
            rows.append(([float(e + 1)], [float(e + 10)], i / 10, i, e, index, t))
            index += 1
    frames = spark.createDataFrame(
        rows, f"`{STATE}` array<float>, {ACTION} array<float>, timestamp float, frame_index long, episode_index long, index long, task_index long"
    )
    episodes = spark.createDataFrame(
        [(e, [NAMES[t]], n) for e, (n, t) in enumerate(zip(LENGTHS, TASKS))], "episode_index long, tasks array<string>, length long"
    )
    tasks = spark.createDataFrame(list(enumerate(NAMES)), "task_index long, task string")
    stats = spark.createDataFrame(
        [(e, {STATE: {"min": [e + 1.0], "max": [e + 1.0], "mean": [e + 1.0], "std": [0.0], "count": [n]}}) for e, n in enumerate(LENGTHS)],
        "episode_index long, stats map<string,struct<min:array<double>,max:array<double>,mean:array<double>,std:array<double>,count:array<bigint>>>"
    )
    features = {STATE: {"dtype": "float32", "shape": [1]}, ACTION: {"dtype": "float32", "shape": [1]}, "observation.images.top": {"dtype": "video"}}
    return Dataset(frames, episodes, tasks, DatasetInfo(fps=10, chunks_size=2, total_episodes=999, features=features), stats)


def frames_of(spark, episodes: dict[int, list], dims: int | None = None):
    """Frames from {episode: rows of numbers}; action is empty."""
    rows = [(e, i, [float(x) for x in np.atleast_1d(v)], [], float(i) / 30, 0) for e, values in episodes.items() for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, f"episode_index long, frame_index long, `{STATE}` array<double>, {ACTION} array<double>, timestamp float, task_index long"
    )
