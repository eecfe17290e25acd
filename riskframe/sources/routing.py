"""Choice of a mapping from a file's name."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.mappings import DEFAULT_MAPPINGS


def stem_of(name: str) -> str:
    base = name.rstrip("/").rsplit("/", 1)[-1]
    return base.rsplit(".", 1)[0] if "." in base[1:] else base


def detect_mapping(
    path: str, keys: Iterable[str] = tuple(DEFAULT_MAPPINGS), match: str = "token"
) -> str:
    """First registered key found in the file's stem; a file that names none is an error.

    ``token`` prefers a key that is a word of its own, so ``deposit_atm`` is a cash machine
    file; ``substring`` takes the first key in registry order wherever it stands.
    """
    stem = stem_of(path).lower()
    words = set(re.split("[^a-z0-9]+", stem))
    keys = list(keys)
    named = [k for k in keys if k in words] if match == "token" else []
    for key in named or [k for k in keys if k in stem]:
        return key
    raise ValueError(f"no mapping for {path!r} among {', '.join(sorted(keys))}")


def route(
    file_name: Column, keys: Iterable[str] = tuple(DEFAULT_MAPPINGS), match: str = "token"
) -> Column:
    """The same choice as a column, null where no key matches."""
    base = F.element_at(F.split(file_name, "/"), -1)
    stem = F.lower(F.regexp_replace(base, r"(?<=.)\.[^.]*$", ""))
    words = F.split(stem, "[^a-z0-9]+")
    choices = [F.when(stem.contains(k), k) for k in keys]
    if match == "token":
        choices = [F.when(F.array_contains(words, k), k) for k in keys] + choices
    return F.coalesce(*choices, F.lit(None).cast("string"))


def routed_files(
    files: DataFrame, keys: Iterable[str] = tuple(DEFAULT_MAPPINGS), match: str = "token"
) -> DataFrame:
    """A file catalogue with the chosen mapping per file."""
    return files.withColumn("mapping", route(F.col("file_name"), keys, match))
