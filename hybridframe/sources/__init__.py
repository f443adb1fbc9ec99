"""Where records come from and are kept: collections, databases and markdown files."""
