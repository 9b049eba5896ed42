"""Column expressions. Everything here stays in whole-stage codegen."""
