"""Operators for preparing training data at scale.

Nothing outside this subpackage imports it; it imports nothing from the rest
of the library either, so either half can be installed without the other.
"""
