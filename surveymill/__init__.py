"""Survey editions to respondent table to aggregate tables, as Spark DataFrame jobs."""
