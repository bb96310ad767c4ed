"""Readers: session discovery, text lines, fixed-width tables, configuration files."""
