"""Training-data operators: mixing, language ID, sharding, BPE, dedup, quality, chat."""
