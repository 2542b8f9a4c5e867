"""Operators of a training-data pipeline (near-duplicate and substring removal,
quality and toxicity scores, mixing, nearest neighbours, chat rendering, PII
pseudonyms, BPE) and their registered queries (``queries.QUERIES``,
``queries.ORACLE``)."""
