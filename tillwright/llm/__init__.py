"""Operators of a large-scale training-data pipeline.

Ten operators (near-dedup, URL filters, secret scans, quality rules, benchmark
decontamination, HTML extraction, token files, BPE, sharding, chat formatting)
over the tables ``documents pages benchmark labels conversations``. Nothing
else in the library imports this package.
"""
