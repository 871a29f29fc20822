"""The model DAG, the query registry and the SQL oracle."""
