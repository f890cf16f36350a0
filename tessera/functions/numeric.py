"""Numeric Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def log1p_exp_neg(m: Column) -> Column:
    """``ln(1 + exp(-m))`` without overflow: ``max(-m, 0) + ln(1 + exp(-|m|))``."""
    return F.greatest(-m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))


def logistic_coefficient(y: Column, z: Column) -> Column:
    """Per-row gradient factor ``-y / (1 + exp(y z))`` (multiplies x)."""
    return -y / (F.lit(1.0) + F.exp(y * z))
