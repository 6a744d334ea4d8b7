"""Pre-event prediction tables on Spark: lake, marts, features, models, reports."""
