"""Queries of the training-data operators: name -> (function of (spark, sf_dir), DuckDB SQL or None)."""

from __future__ import annotations

from commentguard.llm import decontaminate, embedding_dedup, filter_audit, hmm, language, mixing, ngram_join, packing, passages, secrets, spelling, toxicity, warc

REGISTRY = {**mixing.QUERIES, **embedding_dedup.QUERIES, **secrets.QUERIES, **toxicity.QUERIES, **warc.QUERIES, **decontaminate.QUERIES,
            **hmm.QUERIES, **ngram_join.QUERIES, **language.QUERIES, **passages.QUERIES,
            **filter_audit.QUERIES, **packing.QUERIES, **spelling.QUERIES}
