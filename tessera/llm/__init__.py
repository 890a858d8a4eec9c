"""Operators for building training corpora: filters, dedup, decontamination, mixing."""
