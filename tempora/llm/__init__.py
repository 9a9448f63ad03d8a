"""Training-data operators: URL filters, near-dedup, ANN, WARC, toxicity, packing,
media columns, suffix-array dedup, licence scans and source mixing.

Nothing outside this subpackage imports it.
"""
