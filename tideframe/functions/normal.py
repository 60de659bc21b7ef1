"""Normal forms in which exchanges, instruments and sides are compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exchange(c: str | Column) -> Column:
    """Lower case without surrounding blanks; null stays null."""
    return F.lower(F.trim(c if isinstance(c, Column) else F.col(c)))


def instrument(c: str | Column) -> Column:
    """``BASE/QUOTE`` for either spelling of an instrument."""
    return F.upper(F.translate(F.trim(c if isinstance(c, Column) else F.col(c)), "-", "/"))


def book_side(c: str | Column) -> Column:
    """bid or ask (offer is ask) in any letter case; null for anything else."""
    s = F.lower(F.trim(c if isinstance(c, Column) else F.col(c)))
    return F.when(s == "bid", "bid").when(s.isin("ask", "offer"), "ask")


def trade_side(c: str | Column) -> Column:
    """buy for BUY/B, sell for SELL/S, else the lower-case text."""
    s = F.upper(F.trim(c if isinstance(c, Column) else F.col(c)))
    return F.when(s.isin("BUY", "B"), "buy").when(s.isin("SELL", "S"), "sell").otherwise(F.lower(s))


def once(c: Column) -> Column:
    """``c``, evaluated once a row however often it is used: as a generator of one row it is not copied into its users.

    Alone in a select beside plain columns. Without it, every field taken from a parsed struct parses the text again.
    """
    return F.explode(F.array(c))
