"""Corpus operators for preparing training data (documents, benchmark, conversations)."""
