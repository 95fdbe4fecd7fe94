"""Operators for training data: tokens, near copies, language, archives, quality, privacy, vectors, packing."""
