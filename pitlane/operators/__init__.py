"""DataFrame -> DataFrame operators, one module per SURVEY §2 heading."""
