"""Operators of a training-data pipeline on whole document tables.

Each module holds one operator with its own interface; ``queries`` derives the
registered results from them. Nothing outside this package imports it.
"""
