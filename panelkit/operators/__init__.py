"""Operators of the form ``DataFrame -> DataFrame``."""
