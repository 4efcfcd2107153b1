"""Operators for preparing training text at corpus scale.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface; ``queries`` derives the digest columns of the
registered ``opN_<name>`` queries from those operators.
"""
