"""Corpus operators for training data: mixing, tokenising, filtering, dedup, sharding.

Nothing outside this subpackage imports it. Its queries are in ``edugauge.llm.queries``.
"""
