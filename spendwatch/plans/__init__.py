"""Query registry (Spark) and the equivalent DuckDB SQL used as an oracle."""
