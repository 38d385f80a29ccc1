"""Independent DuckDB SQL for checking the Spark plans on the benchmark tables."""
