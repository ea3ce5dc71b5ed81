"""Operators for training-data pipelines over tables of documents and pages.

Nothing else in the library imports this package. One module per operator:

``mixing``           sources to target weights, by packed blocks
``licenses``         license phrases and templates, by a set-similarity join
``decontamination``  benchmark passages in documents
``html_extraction``  main text of web pages
``sharding``         shards of equal bytes, by histogram sort
``substring_dedup``  repeated passages, by content-defined chunks
``quality``          quality scores, by random indexing and a small network
``exact_dedup``      copies of whole texts
``line_dedup``       lines that many documents share
``simhash``          near copies, by fingerprints
``divergence``       word use by source, by stripes of terms
``whitening``        decorrelated embeddings, by variances of sums
``pii``              personal data, by contexts learned from sure finds
``queries``          one query per operator, and the SQL that computes the same
"""
