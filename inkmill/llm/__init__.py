"""Operations of a training-data pipeline over ``documents``-like tables.

Nothing else in the library imports this subpackage.
"""
