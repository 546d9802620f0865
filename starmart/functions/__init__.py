"""Column expressions: dates, codes, bands, visas, places. Everything stays inside code generation."""
