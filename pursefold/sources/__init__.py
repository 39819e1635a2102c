"""Daily text files in, Parquet lake and table snapshots out."""
