"""All queries of this subpackage: name -> (function, DuckDB SQL or None)."""

from matchloom.llm import (
    conversations, decontaminate, lines, merkle, mixing, neardup, packing, quality, secret_scan, suffix_dedup, tokens, urlfilter, warc)

QUERIES = {**decontaminate.QUERIES, **lines.QUERIES, **neardup.QUERIES, **quality.QUERIES, **secret_scan.QUERIES, **suffix_dedup.QUERIES, **tokens.QUERIES,
           **urlfilter.QUERIES, **warc.QUERIES, **mixing.QUERIES, **packing.QUERIES, **conversations.QUERIES, **merkle.QUERIES}
