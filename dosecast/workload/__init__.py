"""The checked workload: adapter views on the driver tables, queries, and SQL for each."""
