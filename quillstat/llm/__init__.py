"""Operators for large-scale training-data pipelines.

Thirteen self-contained operators (near-duplicates, line dedup, language id, URL
filter, BPE, sharding, exact top-k, quality rules, HTML extraction, mixing, a
quality classifier, phrases, cross-tokenizer alignment);
``queries`` registers one query per operator.  Nothing else in the library
imports this subpackage.
"""
