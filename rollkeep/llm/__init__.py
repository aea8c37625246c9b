"""Operators for training-data preparation: each module holds one operator; `queries` registers them.

Nothing outside this subpackage imports it.
"""
