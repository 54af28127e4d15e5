"""Training-data operators: tokens, neighbours, near duplicates, privacy, quality, sharding."""
