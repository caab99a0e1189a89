"""Check and history operators; each returns a lazy DataFrame."""
