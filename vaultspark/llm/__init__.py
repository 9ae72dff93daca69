"""Operators of a training-data pipeline: sharding, near-dedup, PII, WARC, packing, line dedup,
decontamination, quality and toxicity classifiers, exact vector search.

Nothing outside this package imports it.  Every operator takes DataFrames and returns DataFrames; the thin
contract queries are in ``queries`` and their DuckDB SQL in ``oracles``.
"""
