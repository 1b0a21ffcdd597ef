"""Jobs over robot-learning episode datasets on Spark: frames are rows, an episode is a run of them."""
