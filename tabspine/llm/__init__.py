"""Operators for preparing training text: language, licences, archives, duplicates, quality, leaks, neighbours, models, packing."""
