"""Sources: log streams, detail tables, key lists, and the adapters that
derive those inputs from the driver tables."""
