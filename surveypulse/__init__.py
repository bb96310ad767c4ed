"""Survey-log quality checks for airborne logging sessions, as Spark jobs.

Every operator takes DataFrames plus the names of their key, order and channel
columns, and returns a DataFrame; nothing runs until an action is called, except
where a docstring says that a size is checked first.
"""

SESSION_KEYS = ("dataset", "session")

__all__ = ["SESSION_KEYS"]
