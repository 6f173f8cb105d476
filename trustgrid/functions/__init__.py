"""Column -> Column expressions (all built-in, codegen-friendly, ANSI-safe)."""
