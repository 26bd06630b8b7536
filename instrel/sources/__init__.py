"""Readers and writers of the Q&A, package and filtered-passage tables."""
