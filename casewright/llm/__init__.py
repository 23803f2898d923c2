"""Operators for preparing training text: filters, duplicates, extraction and mixing."""
