"""Operators of a training-data pipeline (archives, packing, chat, dedup, ...).

Every module holds one operator; ``queries`` registers one ``opN_<name>``
query per operator.  Nothing outside this package imports it.
"""
