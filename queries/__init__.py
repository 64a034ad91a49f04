"""Queries over the TPC-H-like tables, each beside an independent SQL form."""
