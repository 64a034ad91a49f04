"""The eight jobs, from raw records to scored results."""
