"""CSV feeds and the retail views over the supplied Parquet tables."""
