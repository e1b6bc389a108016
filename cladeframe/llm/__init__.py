"""Training-data preparation: deduplication, cleaning, decontamination, mixing and scans.

Nothing else in the library imports this subpackage.
"""
