"""Training-data operators: quality rules, mixing, extraction, near duplicates,
decontamination, URL lists, pseudonyms, chat windows, token files, toxicity.

Nothing outside this subpackage imports it.
"""
