"""Training-data operators: language ID, byte BPE, licences, near-duplicates, search, sharding, packing, toxicity.

Nothing else in the library imports this subpackage.
"""
