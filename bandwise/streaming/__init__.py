from bandwise.streaming.scoring import coverage_monitor, score_stream  # noqa: F401
