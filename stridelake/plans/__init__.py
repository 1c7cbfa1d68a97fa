"""Composed plans: silver, the layered lake, the batch pipeline, mart questions."""
