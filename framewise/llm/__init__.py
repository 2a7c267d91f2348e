"""Training-data operators: near and exact duplicates, scoring, quality, decontamination,
sharding, tokens and personal data.  Nothing else in the library imports this subpackage."""
