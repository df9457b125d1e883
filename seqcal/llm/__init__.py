"""Operators for training-data pipelines: one module for each, on documents(doc_id, text, ...)."""
