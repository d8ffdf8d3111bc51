"""Operators for preparing language-model training text at scale.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``registry`` derives the digest rows
of the registered queries from them.
"""
