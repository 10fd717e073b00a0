"""Operations of a training-data pipeline: deduplication, filtering, scoring and tokenisation of text corpora.

Nothing outside this subpackage imports it.
"""
