"""Operators for preparing text and embeddings for the training of language models."""
