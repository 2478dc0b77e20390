"""Training-data operators: quality rules, deduplication, decontamination, scoring, mixing and token output.

Nothing else in ``panelcast`` imports this subpackage.
"""
