"""Pure Column expressions (mappers, buckets, scores, tokens, rounding)."""
