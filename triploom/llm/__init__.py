"""Training-data operators: cleaning, joining, scoring and tokenising text
tables. Nothing outside this subpackage imports it."""
