"""Training-data operators (n-gram join, BPE, decontamination, language ID, PII,
fingerprints, substring dedup, chat formatting, URL filters, license scans).

Nothing else in the library imports this package.  Every operator takes and
returns DataFrames; Spark partitions and shuffles the work, and Python, where it
is used, sees one bounded batch of rows at a time.
"""
