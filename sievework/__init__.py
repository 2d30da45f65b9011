"""Spec-driven preparation, profiling and modelling of tabular records on Spark."""
