"""Writing: dated archives, replaced tables, keyed upserts."""
