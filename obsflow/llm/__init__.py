"""Operators for preparing training data, and the queries that apply them."""

from obsflow.llm import blocks, languages, mixing, packing, preferences, repair, secrets, simhash, spherical, substrings, syncmers, urls, whitening  # noqa: F401
