"""Sales mart on Spark: raw sales extracts to a star schema, DataFrame in, DataFrame out."""
