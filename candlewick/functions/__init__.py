"""Expressions as SQL text: every function takes and returns expression text, to be
used with ``expr`` and ``selectExpr``. One parsed text costs one call to the JVM,
where the same expression built column by column costs dozens."""
