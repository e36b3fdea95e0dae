"""Column-level helpers: all of them return built-in Spark Column expressions,
so they stay inside whole-stage codegen."""
