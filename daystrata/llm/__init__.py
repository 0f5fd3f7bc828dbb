"""Operators for preparing training data: tokens, rules, chat, packing, near-duplicates, language, shards."""
