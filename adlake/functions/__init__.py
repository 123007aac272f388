"""Column-level helpers. Every one returns a Spark ``Column`` or plain schema objects."""
