"""Training-data operators: token counts, similarity joins, deduplication, formatting, packing, quality."""
