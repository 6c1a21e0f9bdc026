"""Column-level building blocks: keys, rules, features, calendar parts, code lists."""
