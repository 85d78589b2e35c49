"""Operators for preparing training text.  Nothing else in the library imports this subpackage.

Shared rules, unless an operator's docstring says otherwise: a null text counts
as the empty text; repeated rows each get their own result; columns other than
those an operator names are ignored, whatever they are called; empty tables
give empty results with the same schema.
"""
