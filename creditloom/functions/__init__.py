"""Column expressions: every helper takes and returns `Column`, nothing runs."""
