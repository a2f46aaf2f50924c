"""Training-data operators: mixing, near-duplicates, secrets, toxicity, archives,
decontamination, language models, language identification, repeated passages."""
