"""Document-corpus engine on Spark: scan, extract, index, pack, catalog, sign, check."""
