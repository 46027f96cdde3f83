"""Operators for training-data pipelines: dedup, search, scoring, packing, tokens, chat, language."""
