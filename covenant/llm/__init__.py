"""Training-data operators: language ID, packing, token counts, exact search, joins, filters and mixing.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own interface; ``queries`` registers the contract queries.
"""
