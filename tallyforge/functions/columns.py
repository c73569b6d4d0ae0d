"""Column expressions used across the operators. All stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def resolve_country(os: Column | str, ip: Column | str, home: str = "CN") -> Column:
    """OS country where it is ``home``, else the IP country (also for a null OS)."""
    os, ip = _col(os), _col(ip)
    return F.when(os == home, os).otherwise(ip)


def payer_id(paid: Column | str, account: Column | str) -> Column:
    """The account id where something was paid, else null: distinct-counting it counts payers."""
    return F.when(_col(paid) > 0, _col(account))


def name_or_id(name: Column | str, ident: Column | str) -> Column:
    return F.coalesce(_col(name), _col(ident))


def strip_prefix(c: Column | str, prefix: str, sep: str = ".") -> Column:
    """Second ``sep``-separated part of values that start with ``prefix``; others unchanged."""
    c = _col(c)
    return F.when(c.startswith(prefix), part_after(c, sep)).otherwise(c)


def part_after(c: Column | str, sep: str = ".", index: int = 1) -> Column:
    """``index``-th part after splitting at the literal ``sep``; null where there is none."""
    literal = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return F.get(F.split(_col(c), literal), F.lit(index))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double quotient, null for a zero or null denominator."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def total_use(free: str = "free_use", paid: str = "paid_use") -> Column:
    return F.col(free) + F.col(paid)


def label_like(c: Column | str, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first SQL ``LIKE`` pattern that matches; ``rules`` is (pattern, label) in order."""
    c = _col(c)
    out = None
    for pattern, label in rules:
        hit = c.like(pattern)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    fallback = F.lit(default).cast("string")
    return fallback if out is None else out.otherwise(fallback)


def label_in(c: Column | str, groups: Sequence[tuple[str, Sequence]], default: str | None = None) -> Column:
    """Label of the first listed group that holds the value."""
    c = _col(c)
    out = None
    for label, members in groups:
        hit = c.isin(list(members))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    fallback = F.lit(default).cast("string")
    return fallback if out is None else out.otherwise(fallback)


def label_upto(c: Column | str, edges: Sequence[tuple[object, str]], above: str) -> Column:
    """Label of the first upper edge the value does not exceed (edges included); null stays null."""
    c = _col(c)
    out = None
    for edge, label in edges:
        edge = edge if isinstance(edge, Column) else F.lit(edge)
        hit = c <= edge
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.when(c.isNotNull(), F.lit(above))


def label_below(c: Column | str, edges: Sequence[tuple[object, str]], above: str) -> Column:
    """Label of the first upper edge the value stays under (edges excluded); null stays null."""
    c = _col(c)
    out = None
    for edge, label in edges:
        hit = c < F.lit(edge)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.when(c.isNotNull(), F.lit(above))


def sign(amount: Column | str) -> Column:
    """``+`` for a gain, ``-`` for everything else, zero included."""
    return F.when(_col(amount) > 0, F.lit("+")).otherwise(F.lit("-"))
