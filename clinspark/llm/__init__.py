"""Training-data operators: mixing, deduplication, archives, chat text, packing, filters."""
