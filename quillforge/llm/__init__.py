"""Training-data operators: quality, URL, extraction, dedup, packing, secrets, media and mixing."""
