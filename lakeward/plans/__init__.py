"""Entity specifications, star schema, KPI views and reports."""
