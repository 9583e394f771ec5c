"""Column expressions: JVM-side, codegen-friendly building blocks."""
