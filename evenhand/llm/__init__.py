"""Operators for training-data corpora: encoding, language, duplicates, mixing, shards, quality and licences."""
