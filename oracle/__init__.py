"""Independent DuckDB SQL restatement of every registered query (the correctness oracle)."""
