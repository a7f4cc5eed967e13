"""Independent SQL for checking the queries on another engine."""
