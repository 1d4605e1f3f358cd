"""Plan inspection, the registered jobs and the SQL they are checked against."""
