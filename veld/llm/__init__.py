"""Operators for preparing training data at scale (quality, language model, decontamination,
token files, rules, secrets, personal data, near duplicates, tokenizer, URL filters).

Each operator has a general interface over any DataFrame; ``queries.py`` holds the thin
registered ``opN_<name>`` queries.  Nothing outside this package imports it.
"""
