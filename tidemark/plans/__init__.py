"""Stand-in inputs from the driver tables, the registered queries and their SQL twins."""
