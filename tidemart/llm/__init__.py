"""Operators for preparing training data: tokens, filters, duplicates, archives.

One module per operator; ``queries`` registers the ``opN_<name>`` queries.
Nothing else in the library imports this subpackage.
"""
