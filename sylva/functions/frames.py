"""Pandas frames on their way back to Spark."""

from __future__ import annotations

import pandas as pd


def plain(pdf: pd.DataFrame) -> pd.DataFrame:
    """Text columns as objects: text kept in several Arrow chunks, or in none, can't become one Arrow array."""
    return pd.DataFrame({c: pdf[c] if pd.api.types.is_numeric_dtype(pdf[c]) or pd.api.types.is_bool_dtype(pdf[c]) else pd.Series(pdf[c].tolist(), dtype=object) for c in pdf.columns})
