"""Reading claims, batches, templates and artifact lists; writing results."""
