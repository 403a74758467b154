"""Expressions over base and quality strings (Phred+33)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PHRED_OFFSET = 33
MAX_QUALITY_CHAR = 126


def _without(text: Column, first: str, last: str) -> Column:
    """Characters of ``text`` outside a code range; runs are cut in one regex step."""
    return F.regexp_replace(text, rf"[\x{ord(first):02x}-\x{ord(last):02x}]+", "")


def bases_at_least(qual: Column, phred: int) -> Column:
    return F.length(qual) - F.length(_without(qual, chr(PHRED_OFFSET + phred), chr(MAX_QUALITY_CHAR)))


def bases_below(qual: Column, phred: int) -> Column:
    return F.length(qual) - F.length(_without(qual, chr(PHRED_OFFSET), chr(PHRED_OFFSET + phred - 1)))


def count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def gc_bases(seq: Column) -> Column:
    return count_char(seq, "G") + count_char(seq, "C")


def n_bases(seq: Column) -> Column:
    return count_char(seq, "N")


def phred_sum(qual: Column) -> Column:
    """Sum of the Phred scores of a quality string."""
    codes = F.split(qual, "")
    total = F.aggregate(codes, F.lit(0), lambda acc, c: acc + F.ascii(c))
    return total - F.lit(PHRED_OFFSET) * F.length(qual)


def low_quality(qual: Column, min_quality: int, max_low_percent: int) -> Column:
    """Mean Phred below the minimum, or too large a share of bases below it.

    Bases at twice the minimum or more outweigh as many low ones, so the per-base sum is only
    worked out for reads whose low bases outnumber them.
    """
    size = F.length(qual)
    low = bases_below(qual, min_quality)
    many_low = low * 100 > size * max_low_percent
    # most reads have none, and their high bases are not counted
    can_be_low = (low > 0) & (low > bases_at_least(qual, 2 * min_quality))
    return many_low | (can_be_low & (phred_sum(qual) < size * min_quality))


def terminal_run(seq: Column) -> Column:
    """Length of the homopolymer (A, C, G or T) that ends the sequence."""
    last = F.right(seq, F.lit(1))
    run = F.length(seq) - F.length(F.rtrim(seq, last))
    return F.when(last.isin("A", "C", "G", "T"), run).otherwise(F.lit(0))


def polyx_keep(seq: Column, min_run: int) -> Column:
    """Length left after a terminal homopolymer of at least ``min_run`` is cut."""
    run = terminal_run(seq)
    return F.length(seq) - F.when(run >= min_run, run).otherwise(F.lit(0))


def polya_start(seq: Column, min_run: int, cg_min_run: int) -> Column:
    """1-based start of the first A-run that is long enough, or long enough and followed by CG; 0 if none."""
    motifs = ["A" * min_run] + ["A" * k + "CG" for k in range(min_run - 1, cg_min_run - 1, -1)]
    found = [F.nullif(F.instr(seq, m), F.lit(0)) for m in motifs]
    first = F.least(*found) if len(found) > 1 else found[0]
    return F.coalesce(first, F.lit(0))
