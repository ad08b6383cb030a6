"""Operators for preparing training text at scale, next to the sensor operators.

Each module holds one operator with an interface of its own; ``queries`` applies them to the
test tables. Nothing else in the library imports this subpackage.
"""
