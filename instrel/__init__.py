"""Spark DataFrame operators for instruction-following retrieval data.

Tables go in, tables come out: question-answer rows become prompt requests,
model completions become nested passage packages (or rejects), packages are
described, selected from, routed by relevance, checked and exported.
"""

__version__ = "0.1.0"
