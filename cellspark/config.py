"""Parameters of the engine as frozen dataclasses; all are driver-side settings."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ReadQcConfig:
    """Read trimming and filtering parameters."""

    barcode_length: int = 13
    sss_nmer: int = 8
    min_read_length: int = 5
    polyx_min_run: int = 10
    min_quality: int = 15
    max_low_quality_percent: int = 40
    max_n_bases: int = 5
    polya_min_run: int = 15
    polya_cg_min_run: int = 13
    high_quality: int = 30
    # the older poly-A step also dropped reads of exactly ``min_read_length``
    polya_strict_length: bool = False


@dataclass(frozen=True)
class AssignConfig:
    """Feature assignment parameters."""

    min_overlap_fraction: float = 0.5
    stranded: bool = True
    max_mismatches: int = 3
    # Width of an annotation bin, and how far a lookup may reach into the next bin (at most the width).
    # Genomes with densely packed genes are served better by narrower bins.
    bin_size: int = 4096
    bin_reach: int = 512
    # Annotation bins with more gene pieces than this are looked up piece by piece instead of in the row.
    max_pieces_per_bin: int = 256
    strict_ids: bool = False


@dataclass(frozen=True)
class CellConfig:
    """Cell-calling parameters."""

    minimum_count_threshold: float = 100.0
    density_points: int = 200
    max_inflection_slope: float = 0.2


@dataclass(frozen=True)
class GenomeSpec:
    """Names that an annotation uses for mitochondria and, if mixed, for the two species."""

    mito_chromosome: str = ""
    mixed_species: bool = False
    hsap_mito_chromosome: str = ""
    mmus_mito_chromosome: str = ""
    hsap_gene_prefix: str = ""
    mmus_gene_prefix: str = ""


# Registry keys, mitochondrial names and species prefixes.
GENOMES: dict[str, GenomeSpec] = {
    "GRCh38": GenomeSpec("MT"),
    "GRCm39": GenomeSpec("MT"),
    "BDGP6": GenomeSpec("mitochondrion_genome"),
    "Sscrofa11": GenomeSpec("MT"),
    "GRCz11": GenomeSpec("MT"),
    "mouse_human_mix": GenomeSpec(
        mixed_species=True,
        hsap_mito_chromosome="GRCh38_MT",
        mmus_mito_chromosome="GRCm39_MT",
        hsap_gene_prefix="GRCh38_",
        mmus_gene_prefix="GRCm39_",
    ),
}


@dataclass(frozen=True)
class EngineConfig:
    """All parameter groups of one run."""

    qc: ReadQcConfig = field(default_factory=ReadQcConfig)
    assign: AssignConfig = field(default_factory=AssignConfig)
    cells: CellConfig = field(default_factory=CellConfig)
    genome: GenomeSpec = field(default_factory=lambda: GENOMES["GRCh38"])
