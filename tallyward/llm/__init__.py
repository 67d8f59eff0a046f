"""Training-data operators: filtering, deduplication, decontamination, packing."""
