"""Operators for preparing large-scale training data.

Thirteen operators, a module or two each, plus ``registry`` (the ``opN_*`` queries and
their SQL).  Nothing outside this subpackage imports it except the guarded
import of the driver entry.
"""
