"""Writers: interval replace, upsert, keyed messages."""
