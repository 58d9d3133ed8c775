"""The registered queries: base views, Spark plans and the SQL they are checked against."""
