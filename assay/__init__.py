"""Customer-data refinery on Spark: landing CSV -> bronze -> silver -> gold."""
