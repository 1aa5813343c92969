"""Operators for preparing large text corpora: near-duplicates, decontamination,
toxicity, URL rules, license spans, language, top-k search, mixing, pseudonyms, shards.

Nothing else in the library imports this subpackage.
"""
