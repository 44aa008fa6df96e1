"""Per-game statistics on Spark: clean, lay out and report over fact tables."""
