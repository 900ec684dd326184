"""Training-data operators: text cleaning, packing, search and near-duplicate joins.

Each module holds one operator with its own general interface; ``queries``
applies them to the given tables.  Nothing outside this package imports it.
"""
