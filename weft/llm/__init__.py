"""Operators for training-data pipelines: sampling, tokenising, de-duplication, classification and scoring of text."""
