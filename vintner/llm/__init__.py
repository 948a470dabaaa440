"""Training-data operators: quality, duplicates, extraction, archives, packing."""
