"""Project settings from TOML, and sample lists."""

from __future__ import annotations

import tomllib
from collections import Counter
from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass
class Reference:
    domains: str
    gc_table: str
    index: str | None = None
    fasta: str | None = None
    sample_index: str | None = None


@dataclass
class Paths:
    fastq: str = "fastq"
    alignments: str = "alignments"
    results: str = "results"
    logs: str = "logs"
    temp: str = "."


@dataclass
class Options:
    paired: bool = True
    quality_cutoff: int = 10
    min_length: int = 80
    compress: bool = False
    threads: int = 1
    jobs: int = 8
    aligner_args: list[str] = field(default_factory=list)


@dataclass
class Project:
    reference: Reference
    paths: Paths = field(default_factory=Paths)
    options: Options = field(default_factory=Options)
    samples: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        twice = [s for s, n in Counter(self.samples).items() if n > 1]
        if twice:
            raise ValueError(f"samples listed more than once: {', '.join(twice)}")

    def check_reference(self) -> None:
        missing = [p for p in (self.reference.domains, self.reference.gc_table) if not Path(p).exists()]
        if missing:
            raise FileNotFoundError(", ".join(missing))


def _built(kind: type, table: dict, where: str):
    unknown = set(table) - {f.name for f in fields(kind)}
    if unknown:
        raise ValueError(f"unknown settings in {where}: {', '.join(sorted(unknown))}")
    return kind(**table)


def load_project(path: str) -> Project:
    table = tomllib.loads(Path(path).read_text())
    if "reference" not in table:
        raise ValueError("a project needs [reference]")
    parts = {n: _built(k, table.pop(n), n) for n, k in (("reference", Reference), ("paths", Paths), ("options", Options)) if n in table}
    return _built(Project, parts | table, "the project")


def shell_samples(text: str) -> list[str]:
    """Names in the SAMPLES=( ... ) array of a shell script, one a line."""
    lines = iter(text.splitlines())
    for line in lines:
        if "SAMPLES" in line:
            break
    out = []
    for line in lines:
        if line.strip() == ")":
            break
        if line.strip():
            out.append(line.strip())
    return out
