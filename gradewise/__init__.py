"""Binary classification of large raw tables, written as Spark DataFrame operators.

Packages:

``functions``  column expressions (missing values, text, labels, hashes, votes)
``sources``    delimited files, report files, shared scratch tables
``operators``  one module per step: cleaning, labelling, features, sampling,
               training, evaluation, tuning, comparison
``plans``      the whole experiment, raw table to reports
"""
