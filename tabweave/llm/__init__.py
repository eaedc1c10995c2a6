"""Operators for preparing training data: one module per operator, their queries in `queries`.

Nothing else in the library imports this package. Texts are read whole; a null text counts as empty unless a
docstring says otherwise; columns that an operator does not name pass through it or are left out, as documented.
"""
