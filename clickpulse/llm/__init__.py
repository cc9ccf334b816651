"""Training-data operators: sampling, search, filters, tokens, fingerprints, scoring, near-duplicates."""
