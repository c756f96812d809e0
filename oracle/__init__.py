"""DuckDB SQL that states, independently of the Spark code, what each query must return."""
