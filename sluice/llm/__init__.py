"""Training-data operators: filtering, de-duplication, tokenisation and layout of text corpora.

Nothing outside this subpackage imports it.
"""
