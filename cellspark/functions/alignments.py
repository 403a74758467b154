"""Expressions over SAM flags, CIGAR strings and positions (1-based, inclusive)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLAG_UNMAPPED = 0x4
FLAG_REVERSE = 0x10
FLAG_SECONDARY = 0x100
FLAG_QC_FAIL = 0x200
FLAG_DUPLICATE = 0x400
FLAG_SUPPLEMENTARY = 0x800

BLOCK = "struct<start:bigint,end:bigint>"


def has_flag(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) != 0


def is_primary(flag: Column) -> Column:
    return ~has_flag(flag, FLAG_SECONDARY | FLAG_SUPPLEMENTARY)


def strand(flag: Column) -> Column:
    return F.when(has_flag(flag, FLAG_REVERSE), F.lit("-")).otherwise(F.lit("+"))


def _sum_ops(cigar: Column, ops: str) -> Column:
    sizes = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{ops}]"), F.lit(1))
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda acc, n: acc + n.cast("long"))


def _simple(cigar: Column) -> Column:
    return cigar.rlike(r"^\d+M$")


def reference_end(pos: Column, cigar: Column) -> Column:
    """Last reference base the alignment covers."""
    simple = F.rtrim(cigar, F.lit("M")).try_cast("long")
    span = F.when(_simple(cigar), simple).otherwise(_sum_ops(cigar, "MDN=X"))
    return pos + span - 1


def single_run(cigar: Column) -> Column:
    """Whether the alignment is one M run, apart from clipped ends."""
    return cigar.rlike(r"^(?:\d+[SH])*\d+M(?:\d+[SH])*$")


def run_length(cigar: Column) -> Column:
    """Length of the first M run."""
    return F.regexp_extract(cigar, r"(\d+)M", 1).try_cast("long")


def read_length(cigar: Column) -> Column:
    """Bases of the read sequence, from the CIGAR string; the sequence column stays unread."""
    simple = F.rtrim(cigar, F.lit("M")).try_cast("long")
    return F.when(_simple(cigar), simple).otherwise(_sum_ops(cigar, "MIS=X"))


def aligned_blocks(pos: Column, cigar: Column) -> Column:
    """One (start, end) block per aligned (M, = or X) run of the CIGAR string."""
    simple = F.array(
        F.struct(
            pos.cast("long").alias("start"),
            (pos + F.rtrim(cigar, F.lit("M")).try_cast("long") - 1).alias("end"),
        )
    )
    sizes = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIDNSHP=X]"), F.lit(1))
    kinds = F.regexp_extract_all(cigar, F.lit(r"\d+([MIDNSHP=X])"), F.lit(1))
    steps = F.zip_with(
        sizes,
        kinds,
        lambda n, k: F.struct(n.cast("long").alias("n"), k.alias("k")),
    )
    empty = F.array().cast(f"array<{BLOCK}>")

    def advance(acc: Column, step: Column) -> Column:
        block = F.struct(
            acc["at"].alias("start"), (acc["at"] + step["n"] - 1).alias("end")
        )
        covers = step["k"].isin("M", "=", "X")
        moves = covers | step["k"].isin("D", "N")
        return F.struct(
            F.when(moves, acc["at"] + step["n"]).otherwise(acc["at"]).alias("at"),
            F.when(covers, F.concat(acc["blocks"], F.array(block))).otherwise(acc["blocks"]).alias("blocks"),
        )

    start = F.struct(pos.cast("long").alias("at"), empty.alias("blocks"))
    general = F.aggregate(steps, start, advance, lambda acc: acc["blocks"])
    return F.when(_simple(cigar), simple).otherwise(general)


def five_prime(flag: Column, pos: Column, cigar: Column) -> Column:
    """Position of the first sequenced base, moved out over soft-clipped ends."""
    clipped = cigar.contains("S")
    leading = F.coalesce(F.when(clipped, F.regexp_extract(cigar, r"^(?:\d+H)?(\d+)S", 1).try_cast("long")), F.lit(0))
    trailing = F.coalesce(F.when(clipped, F.regexp_extract(cigar, r"(\d+)S(?:\d+H)?$", 1).try_cast("long")), F.lit(0))
    forward = pos.cast("long") - leading
    reverse = reference_end(pos.cast("long"), cigar) + trailing
    return F.when(has_flag(flag, FLAG_REVERSE), reverse).otherwise(forward)
