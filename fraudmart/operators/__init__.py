"""Relational building blocks: batch selection and client chain, split windows,
the fraud rules, warehouse loads and dimension maintenance."""
