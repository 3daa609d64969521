"""Column expressions; all of them built-in expressions of Spark SQL, none depends on the session's time zone."""
