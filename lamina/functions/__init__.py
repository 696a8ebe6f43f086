"""Building blocks for single values.

They take and return SQL expression text, to be nested freely and handed to
``selectExpr`` or ``expr``. One projection of forty columns is then one call
into the session, and everything in it is built-in, generated code.
"""
