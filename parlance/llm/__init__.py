"""Training-data operators: dedup, scoring, extraction, decontamination, mixing.

Nothing else in the library imports this subpackage.
"""
