"""End-to-end plans: raw lines to base tables, base tables to the dashboard table."""
