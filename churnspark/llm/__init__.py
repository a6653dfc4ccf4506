"""Operators for preparing training text at scale, one module each.

Nothing else in the library imports this subpackage.  ``queries`` registers
one query per operator; the modules hold the general operators.
"""
