"""Operators for preparing large training corpora.

Each takes a DataFrame with a document id and a text (or a url) and returns a
DataFrame; nothing else in the library imports them.
"""
