"""Operators of a training-data pipeline: sharding, licence scans, set-similarity joins,
HTML main text, token counts, fingerprints, mixing, secret scans, decontamination, a quality
classifier, a source audit, periodic runs and chat formatting.  Nothing else in the library
imports this package."""
