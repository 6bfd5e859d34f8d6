"""Operators for preparing training data: language, quality, toxicity, licences, fingerprints, shards, mixes and pieces."""
