"""Column expressions: text cleaning, keys, times, seasonal encodings."""
