"""Expressions over read names, gene ids and gene names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def barcode_from_r2(r2_seq: Column, length: int = 13) -> Column:
    """First ``length`` bases of the right-trimmed mate; NULL when it is shorter."""
    clean = F.rtrim(r2_seq, F.lit(" \t\r\n"))
    return F.when(F.length(clean) >= length, F.substring(clean, 1, length))


def tagged_header(header: Column, barcode: Column) -> Column:
    """``@NAME REST`` -> ``@NAME_BC_ REST``; without a space the tag ends the name."""
    clean = F.rtrim(header, F.lit(" \t\r\n"))
    space = F.instr(clean, " ")
    head = F.when(space > 0, F.substring(clean, F.lit(1), space - 1)).otherwise(clean)
    rest = F.when(space > 0, F.substring(clean, space, F.length(clean))).otherwise(F.lit(""))
    return F.concat(head, F.lit("_"), barcode, F.lit("_"), rest)


def barcode_for_counting(read_name: Column) -> Column:
    """Upper-case letters between the last two underscores at the end of the name, else ''."""
    return F.regexp_extract(read_name, "_([A-Z]+)_$", 1)


def barcode_for_categorizing(read_name: Column, length: int = 13) -> Column:
    """First ``_BARCODE_`` of exactly ``length`` bases anywhere in the name, else NULL."""
    return F.nullif(F.regexp_extract(read_name, f"_([ACGTN]{{{length}}})_", 1), F.lit(""))


def gene_from_tag(xt: Column, strict: bool = False) -> Column:
    """Gene id of an assignment tag: its leading word characters, or all of it if ``strict``."""
    return xt if strict else F.regexp_extract(xt, "^[A-Za-z0-9_]+", 0)


def strip_version(gene_id: Column) -> Column:
    return F.regexp_replace(gene_id, r"\.\d+$", "")


def name_or_id(gene_name: Column, gene_id: Column) -> Column:
    """Gene name, or the id when the name is missing, empty or the text ``nan``."""
    missing = gene_name.isNull() | F.lower(F.trim(gene_name)).isin("", "nan", "+nan", "-nan")
    return F.when(missing, gene_id).otherwise(gene_name)


def first_seqname(seqname: Column) -> Column:
    return F.split(seqname, ";")[0]
