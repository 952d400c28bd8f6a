"""Log-archive queries as Spark plans."""
