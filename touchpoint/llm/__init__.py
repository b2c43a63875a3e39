"""Operators for preparing training text: quality, duplicates, extraction, tokens, decontamination, packing, licences, search."""
