"""Scalar rules as Column expressions; no UDFs in here."""
