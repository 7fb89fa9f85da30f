"""Training-data operators: one module per operator, one query each.

Nothing else in the library imports this subpackage; ``queries`` and
``oracle`` hold what ``__spark_entry__`` registers.
"""
