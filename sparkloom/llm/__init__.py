"""Training-data operators: sanitising, token files, decontamination, sharding, language
identification, web archives, licence scans, near-duplicates, nearest neighbours, packing.

Nothing else in the library imports this subpackage.
"""
