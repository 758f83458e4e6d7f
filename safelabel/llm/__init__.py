"""Operators that prepare training text: one module per operator, shared helpers in ``hashing``, ``store`` and ``graph``."""
