"""Column-level building blocks: predicates, calendar parts and scoring formulas."""
