"""undercut: vehicle-telemetry analytics as plain PySpark jobs.

Operators are functions from DataFrame to DataFrame and run unchanged in batch
and in Structured Streaming unless their docstring says otherwise.
"""
