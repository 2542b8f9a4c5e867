from labelkiln.streaming.scoring import score, stream_scores  # noqa: F401
