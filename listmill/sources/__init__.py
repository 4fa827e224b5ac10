"""Tables: Parquet inputs and versioned tables."""
