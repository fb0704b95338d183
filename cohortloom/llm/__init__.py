"""Operators for cleaning, judging and packing a training corpus."""
