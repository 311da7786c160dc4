"""Operators for building training data: ten self-contained components.

Nothing outside this subpackage imports it.  Executors need the package on
their Python path (``--py-files`` or an installed wheel).
"""
