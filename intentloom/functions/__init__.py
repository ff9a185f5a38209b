"""Column-level functions: text handling, prompt texts and label matching."""
