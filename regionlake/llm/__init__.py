"""Operators that prepare training text: near copies, fingerprints, token counts, scores, clean-up.

Nothing outside this package imports it. Every operator takes DataFrames and column names and
returns a DataFrame; the ``queries`` module registers one query per operator.
"""
