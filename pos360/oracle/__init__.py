"""Independent DuckDB SQL per registered query, for result checks."""
