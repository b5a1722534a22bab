"""Training-data operators: ten large-scale text operators and their queries.

Nothing else in the library imports this subpackage."""
