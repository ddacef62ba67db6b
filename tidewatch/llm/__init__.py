"""Training-data operators: deduplication, quality, decontamination, packing, scans, language."""
