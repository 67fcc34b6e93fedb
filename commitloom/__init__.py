"""Version-control history as tables, turned into supervised training rows with Spark."""
