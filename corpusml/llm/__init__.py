"""Operators for preparing training text: deduplication, filters, fingerprints, archives, mixing."""
