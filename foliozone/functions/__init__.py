"""Column builders: everything here stays inside whole-stage codegen."""
