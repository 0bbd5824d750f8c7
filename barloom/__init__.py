"""Daily market bars on Spark: load, check, de-duplicate, adjust and publish."""
