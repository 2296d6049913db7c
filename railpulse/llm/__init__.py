"""Operators for preparing language-model training data, one module each.

Nothing else in the package imports this subpackage; ``queries.py`` holds the
registered queries and their oracle SQL."""
