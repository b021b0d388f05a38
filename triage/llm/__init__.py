"""Training-data operators: decontamination, licences, quality, secrets, dedup, PII, tokens, URLs."""
