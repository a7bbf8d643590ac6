"""Operators for preparing training text: mixing, scoring, filtering, packing and duplicate removal."""
