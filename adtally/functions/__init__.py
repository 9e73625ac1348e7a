"""Column expressions: numeric helpers, KPI formulas and text formats."""
