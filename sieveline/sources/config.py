"""Site configurations: YAML files, a folder of them, or rows of a table."""

from __future__ import annotations

import glob
import os
from dataclasses import dataclass, field

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_SITES = 100_000


@dataclass
class SiteConfig:
    """One site. Keys that no field reads are passed over."""

    domain: str
    index_pages: list[str] = field(default_factory=list)
    sitemap: bool = True
    sitemap_url: str | None = None
    allow: list = field(default_factory=list)
    deny: list = field(default_factory=list)
    selectors: dict = field(default_factory=dict)
    meta: dict = field(default_factory=dict)

    @classmethod
    def of(cls, data: dict) -> SiteConfig:
        """Raises ``KeyError`` without a domain; a single index page may stand as a string."""
        found = data.get("discover") or {}
        pages = found.get("index_pages") or []
        return cls(
            data["domain"], [pages] if isinstance(pages, str) else list(pages), bool(found.get("sitemap", True)), found.get("sitemap_url"),
            found.get("allow") or [], found.get("deny") or [], data.get("selectors") or {}, data.get("meta") or {},
        )

    @classmethod
    def from_yaml(cls, path: str) -> SiteConfig:
        with open(path, encoding="utf-8") as f:
            return cls.of(yaml.safe_load(f) or {})


def load_configs(path: str) -> tuple[list[SiteConfig], list[tuple[str, str]]]:
    """Configurations of a file, or of a folder's ``*.yml`` in order; those that fail come back with their error."""
    files = sorted(glob.glob(os.path.join(path, "*.yml"))) if os.path.isdir(path) else [path]
    good, bad = [], []
    for f in files:
        try:
            good.append(SiteConfig.from_yaml(f))
        except Exception as e:  # noqa: BLE001 - one bad site must not stop the others
            bad.append((f, f"{type(e).__name__}: {e}"))
    return good, bad


def configs_frame(spark: SparkSession, configs: list[SiteConfig]) -> DataFrame:
    if len(configs) > MAX_SITES:
        raise ValueError(f"more than {MAX_SITES} sites")
    rows = [(c.domain, c.index_pages, c.sitemap, c.sitemap_url, [str(r) for r in c.allow] if isinstance(c.allow, list) else [], [str(r) for r in c.deny] if isinstance(c.deny, list) else []) for c in configs]
    return spark.createDataFrame(rows, "domain string, index_pages array<string>, sitemap boolean, sitemap_url string, allow array<string>, deny array<string>")


def flat(configs: DataFrame) -> DataFrame:
    """The columns of ``configs_frame`` from a table with a ``discover`` struct."""
    return configs.select("domain", F.col("discover.index_pages").alias("index_pages"), F.col("discover.sitemap").alias("sitemap"), F.col("discover.sitemap_url").alias("sitemap_url"), F.col("discover.allow").alias("allow"), F.col("discover.deny").alias("deny"))
