"""Training-data operators: token counts, decontamination, packing, near and exact dedup, and file formats."""
