"""Files, tables and databases the data comes from and goes to."""
