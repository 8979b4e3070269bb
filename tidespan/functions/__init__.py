"""Builders of SQL expressions: time arithmetic, scores, ratios and text rules.

Every function takes and returns SQL text, to be used with ``selectExpr``, ``filter`` or ``F.expr``. The
rule tables of this library are long; as text a whole rule set reaches the JVM in one call instead of one
call per literal.
"""
