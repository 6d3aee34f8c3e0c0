"""Operators for preparing training text, built on Spark jobs that ship numpy arrays."""
