"""Column expressions; nothing here runs a job."""
