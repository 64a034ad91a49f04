"""The scoring jobs on streams."""
