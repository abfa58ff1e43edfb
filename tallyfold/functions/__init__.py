"""SQL expressions: environment classes, fiscal calendar, money arithmetic.

Each function takes the texts of SQL expressions (column names in the simplest case) and
returns the text of one, for ``selectExpr`` or ``functions.expr``. A text is sent to the JVM in
one call; the same expression built from Column objects takes a call for every operator, which
for a wide report costs more than running it. Values chosen by a user never become part of a
text: they are bound as literals (``operators.filters``).
"""
