"""Operators for preparing training text: scans, deduplication, scoring and tokenisation."""
