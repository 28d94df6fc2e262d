"""Daily market-data pipelines on Spark: feeds in, enriched quotes out."""
