"""Jobs that chain operators, and the catalog of ready-made queries."""
