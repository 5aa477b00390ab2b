"""billetic: ticketing KPI jobs and their DataFrame operators on PySpark."""
