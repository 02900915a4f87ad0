"""Operators for preparing text corpora: formatting, fingerprints, deduplication, filters, mixing."""
