"""Daily-metrics analytics as Spark DataFrame operators.

Convention used by every operator: ``op(df, *, keys=(), ...) -> DataFrame``.  ``keys`` are the
columns that identify one series (``("user_id",)`` for many people); ``keys=()`` is a single series.
Operators are lazy unless their docstring says that one bounded aggregate has to be read first, and
"today" is always the parameter ``as_of``.
"""
