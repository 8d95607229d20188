"""Independent DuckDB SQL for every registered query."""
