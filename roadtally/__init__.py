"""Additive incident analytics on Spark: rollups, mergeable state, reports and an outcome classifier."""
