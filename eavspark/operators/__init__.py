"""Dataflow operators over pages, blocks, chains, values and grids."""
