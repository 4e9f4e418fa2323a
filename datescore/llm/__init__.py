"""Operations of a training-data pipeline on the documents, pages and labels tables.

Nothing else in the library imports this subpackage.
"""
