"""Operators of a training-data pipeline: URL filters, near-duplicate
detection, mixing, tokenising, WARC files, toxicity, quality and licences.

Each operator selects the columns it needs first, so further columns of its
input, whatever their names, neither clash nor change a result. Nothing else
in the library imports this package.
"""
