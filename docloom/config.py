"""Settings of the plans, read from JSON or, where it is installed, YAML; keys that a setting does not know are left out."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Self

from pyspark.sql import SparkSession


class _Loaded:
    @classmethod
    def of(cls, values: dict) -> Self:
        """The settings among ``values``; the others keep their defaults."""
        return cls(**{f.name: values[f.name] for f in fields(cls) if f.name in values})

    @classmethod
    def load(cls, path: str) -> Self:
        text = Path(path).read_text(encoding="utf-8")
        if path.endswith((".yaml", ".yml")):
            import yaml

            return cls.of(yaml.safe_load(text) or {})
        return cls.of(json.loads(text))


@dataclass(frozen=True)
class IngestConfig(_Loaded):
    """From a folder to a chunk store. ``link`` needs a summary and a link model; ``cache_dir`` keeps steps between runs; with ``append`` a
    run's documents are added to the consolidated file, else they are the file."""

    input_dir: str = ""
    output_dir: str = ""
    collection: str = "docs"
    formats: tuple[str, ...] = (".pdf", ".docx", ".html", ".md", ".txt", ".xlsx", ".pptx")
    chunk_size: int = 1000
    chunk_overlap: int = 0
    link: bool = False
    embed_with_summary: bool = True
    cache_dir: str | None = None
    cleanup_cache: bool = False
    append: bool = False

    def check(self, models: dict) -> None:
        """ValueError where the settings ask for what is not there."""
        if self.chunk_size < 1 or self.chunk_overlap < 0:
            raise ValueError("chunk_size must be at least 1 and chunk_overlap at least 0")
        missing = [m for m in ("summary", "relate") if self.link and m not in models]
        if missing:
            raise ValueError(f"linking needs models: {', '.join(missing)}")


@dataclass(frozen=True)
class DatasetConfig(_Loaded):
    """From chunks to a dataset of questions and answers. ``data_source`` is doc, code or pair (both)."""

    data_source: str = "doc"
    questions_per_chunk: int = 10
    easy_question_ratio: float = 0.3
    answer_quality_threshold: float = 0.7
    limit: int | None = None
    tables: dict[str, str] = field(default_factory=dict)

    def tools(self) -> list[str]:
        """What an agent may call: documents are searched for doc and pair, nodes for code and pair; links are followed
        wherever there is a chunk store."""
        if self.data_source not in ("doc", "code", "pair"):
            raise ValueError(f"unknown data source {self.data_source!r}")
        docs, code = self.data_source != "code", self.data_source != "doc"
        return ["search_documentation", "get_linked_chunk"] * docs + ["search_codebase"] * code


def require_table(spark: SparkSession, path: str) -> str:
    """``path`` if there is a table; ValueError if not."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        raise ValueError(f"no table at {path}")
    return path
