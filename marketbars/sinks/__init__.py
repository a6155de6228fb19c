"""Writers: zstd Parquet / CSV, date-partitioned, verified, dynamically published."""
