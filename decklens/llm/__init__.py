"""Operators for large text corpora (fingerprints, classifiers, scans, packing, sharding).

Nothing else in the library imports this package; ``llm.queries`` registers
the thin queries and the driver entry adds them when the package is present.
"""
