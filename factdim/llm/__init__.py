"""Operators of a training-data pipeline over documents and embeddings.

Nothing else in the library imports this package.  Each module holds one operator; ``queries``
registers them for the verification driver.
"""
