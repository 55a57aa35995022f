"""Spark-first analytics for assembly-style interval, link and position data, plus a training-data toolkit."""
