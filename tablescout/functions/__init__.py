"""Column-expression building blocks (all JVM-side, codegen-friendly)."""
