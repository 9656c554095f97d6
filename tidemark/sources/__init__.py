"""Readers. Each returns a lazy DataFrame whose projections and filters Spark pushes down."""
