"""Training-data operators: scans, deduplication, quality, scoring, packing, decontamination."""
