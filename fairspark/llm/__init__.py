"""Training-data operators: URL rules, packing, near-duplicates, decontamination, chat
windows, quality rules, repeated passages, licences, quality scores and token files.

Nothing else in the library imports this subpackage.
"""
