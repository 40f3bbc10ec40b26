"""Operators for preparing training text: one module each, over Spark DataFrames.

Nothing else in the library imports this subpackage. Its parts:

==============  =============================================================
pii             format-preserving Feistel pseudonyms
lines           line dedup with once-seen and twice-seen Bloom filters
langid          language by rank-order profiles
toxicity        severity by cumulative-link ordinal regression
pieces          SentencePiece ids by a table of last tokens of prefixes
secrets         base secrets and linked multipart credentials
simhash         SimHash groups by a binary trie self-join
decontam        benchmark passages by winnowing
warc            metadata and conversion records of responses
merkle          document fingerprints as Merkle trees
turns           repair of conversations by a chunked Viterbi search
codes           codebooks for parts of vectors, trained with pivot bounds
outliers        quality rules by robust covariances
==============  =============================================================

Rules that hold for all of them. Columns are named by the caller and taken by
name at the start, so further columns of a table, whatever their names, neither
clash nor count. A null text is read as an empty one unless the docstring says
otherwise. Texts are processed whole. Intermediate tables go to the folder in
spark.checkpoint.dir, as tables that any executor can read again.
"""
