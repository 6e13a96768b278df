"""Settings of a whole run."""

from __future__ import annotations

from dataclasses import dataclass, field

from contactloom.functions import sites


@dataclass(frozen=True)
class PipelineConfig:
    """Defaults are those of a single-cell run."""

    enzyme: str | None = "MboI"
    second_enzyme: str | None = None
    sizes: str = "150-1500"
    min_repeats: int = 2
    min_quality: int = 10
    scheme: str = "phred33"
    population: bool = False
    report_ambiguous: bool = False
    unique_map: bool = False
    hybrid: bool = False
    copies: int = 0
    junction: str | None = None
    adapters: tuple[str, ...] = ("AGATCGGAAGAGC",)
    trim_5: int = 0
    trim_3: int = 0
    max_reads: int = 0
    separation_mb: float = 40.0
    score_ratio: float = 10.0
    min_contacts: int = 100_000
    enzymes: dict[str, str] = field(default_factory=lambda: dict(sites.ENZYMES))

    def __post_init__(self) -> None:
        for name in (self.enzyme, self.second_enzyme):
            if name is not None and name not in self.enzymes:
                raise ValueError(f"unknown enzyme {name}")
        if not 1 <= self.separation_mb <= 100 or not 1 <= self.score_ratio <= 100:
            raise ValueError("separation and score ratio are between 1 and 100")
        sites.parse_sizes(self.sizes)
        sites.check_adapters(self.adapters)

    @property
    def n_copies(self) -> int:
        return self.copies or (4 if self.hybrid else 2)

    @property
    def site(self) -> str | None:
        return None if self.enzyme is None else self.enzymes[self.enzyme]

    @property
    def ligation_junction(self) -> str | None:
        if self.junction:
            return sites.check_junction(self.junction)
        return None if self.site is None else sites.junction(self.site)
