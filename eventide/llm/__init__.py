"""Operators of a training-data pipeline (dedup, decontamination, tokens, scores).

Each module holds one operator with its own general interface; ``queries``
registers one ``opN_<name>`` query per operator over the given tables.  No
other part of the library imports this subpackage.
"""
