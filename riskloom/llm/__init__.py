"""Corpus operators for training data: filters, de-duplication, scans and tokens."""
