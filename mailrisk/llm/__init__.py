"""Operators for building a training corpus from documents and conversations."""
