"""Column expressions. Built-in Spark functions only, so scans stay in generated code."""
