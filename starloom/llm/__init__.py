"""Operators for preparing training text: quality, de-duplication, language, personal data, mixing and packing."""
