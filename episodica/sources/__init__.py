"""Source tables: declared schemas, loaders, code sets."""
