"""Scalar expressions as Spark SQL text.

Every function takes expression text (a column name, a lambda variable, any
SQL expression) and returns expression text, for ``selectExpr`` and
``F.expr``. A rendered file is one long expression: as text it reaches the
JVM in one call, where thousands of ``Column`` calls would take seconds.
"""
