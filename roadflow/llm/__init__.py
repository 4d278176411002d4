"""Training-data operators: dedup, scans, decontamination, tokenising, classifiers."""
