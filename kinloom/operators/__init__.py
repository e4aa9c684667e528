"""Relational operators over person records."""
