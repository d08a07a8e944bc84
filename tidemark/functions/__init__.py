"""Column expressions: hashing, cleaning, decoding and dates. All are built-in Spark expressions."""
