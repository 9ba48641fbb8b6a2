"""Settings of a run, in one frozen object instead of configuration files."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from datetime import datetime
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from pyspark.sql import SparkSession

#: Columns of the tab-separated files, in order.
CLUSTERING_COLUMNS = (
    "CTRL_ROWID", "G_NO", "G_CLASS", "G_NAME", "RANK", "G_POST_TIME", "G_LASTUPDATE", "G_DIRECT_PRICE", "GROUP_HEAD", "GROUP_NUM", "FINGERPRINT", "UPDATE",
)
SELLER_COLUMNS = ("CTRL_ROWID", "APPLY_STATUS", "ASD_WEIGHT", "_SOURCE_TIME")
#: Fixed value: how a null reads in a tab-separated file.
NULL_TEXT = "(null)"
#: Inclusive upper bounds of the shards' ranges of signed 32-bit hashes; what is above belongs to the last shard.
SHARD_BOUNDS = (
    -1789591553, -1431699457, -1073741825, -715849729, -357957633, -1, 357892095, 715784191, 1073741823, 1431633919, 1789526015,
)


@dataclass(frozen=True)
class Settings:
    """``batch_ts`` stamps every row of a run alike."""

    batch_ts: datetime = datetime(2024, 1, 1)
    hash_bits: int = 256
    band_bits: int = 128
    threshold: int = 10
    flush_docs: int = 1000
    pause_seconds: float = 0.1

    @classmethod
    def load(cls, spark: SparkSession | None = None, path: str | None = None, prefix: str = "spark.shelfline.") -> Settings:
        """Defaults, over them a JSON file's fields, over them the session's settings
        that begin with ``prefix``. Unknown names are refused."""
        found: dict[str, object] = {}
        if path is not None:
            if spark is not None:  # wherever the session's file systems reach
                found |= json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
            else:
                with open(path, encoding="utf-8") as f:
                    found |= json.load(f)
        if spark is not None:
            found |= {k.removeprefix(prefix): v for k, v in spark.conf.getAll.items() if k.startswith(prefix)}
        kinds = {f.name: type(f.default) for f in fields(cls)}
        if unknown := set(found) - set(kinds):
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return cls(**{k: datetime.fromisoformat(str(v)) if kinds[k] is datetime else kinds[k](v) for k, v in found.items()})

    def __post_init__(self) -> None:
        if self.band_bits <= 0 or self.hash_bits <= 0:
            raise ValueError("bands need a positive width")
        if self.flush_docs <= 0:
            raise ValueError("a batch needs at least one document")
