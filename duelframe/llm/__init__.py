"""Training-data operators: extraction, scoring, dedup, mixing, packing.

Nothing else in the package imports this subpackage.  ``queries`` registers
one ``opN_`` query per operator; ``corpus_pipeline`` at the repository top
chains five of them.
"""
