"""DataFrame operators on the Q&A, completion, package and candidate tables."""
