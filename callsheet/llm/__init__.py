"""Training-data operators: quality, token counts, packing, duplicates, language, toxicity, mixing, neighbours."""
