"""Training-data operators: scoring, deduplication, decontamination, mixing and output."""
