"""Operators for training-data corpora: scanning, filtering, linking, searching and packing texts."""
