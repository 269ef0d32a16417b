"""Operators that prepare text for training language models."""
