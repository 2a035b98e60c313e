"""Writers: text outputs in the fixed line formats, Parquet tables."""
