"""Analyses on top of silver. Money is counted once per sale, or per line from
the line's own subtotal, never the sale total once per line.

Each analysis works on a small reduction: one row per customer, day, month,
product, category or address. A reduction comes straight from the fact, or from
stored totals (see ``plans.lattice``), and the analysis does not care which.
"""
