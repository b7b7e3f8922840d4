"""Training-corpus operators: quality, privacy, mixing, language, duplicates, records, archives, toxicity, leaks."""
