"""Operators: write modes, JSON shredding, hub/link/satellite loads, SCD2, quality rules."""
