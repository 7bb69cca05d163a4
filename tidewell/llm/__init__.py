"""Operators for training-data pipelines: counting, classifying, cleaning, deduplicating and packing texts."""
