"""Source layouts mapped onto the canonical fields, and the registry of mappings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.contract import ATM_COLUMNS, CANONICAL_FIELDS, ONLINE_COLUMNS, POS_COLUMNS
from riskframe.functions import clean_text

_RAW = "map<string,string>"
_CLEANED = frozenset(CANONICAL_FIELDS) - {"amount", "raw_source_data"}


@dataclass(frozen=True)
class SourceMapping:
    """How one source layout becomes canonical text columns.

    ``transform`` is any ``DataFrame -> DataFrame``. It must carry along columns whose names
    start with two underscores (the row's origin). Other columns outside the contract may
    pass through and are judged by validation. Amounts stay text here, so that validation
    can tell a missing amount from a malformed one.
    """

    name: str
    required: tuple[str, ...]
    transform: Callable[[DataFrame], DataFrame]

    def missing_columns(self, columns: Iterable[str]) -> list[str]:
        """What a header lacks, in the layout's order. Readers strip header names."""
        return sorted(set(self.required) - {c.strip() for c in columns}, key=self.required.index)

    def require_columns(self, columns: Iterable[str]) -> None:
        if lacking := self.missing_columns(columns):
            raise ValueError(f"a {self.name} file needs {', '.join(lacking)}, which its header lacks")

    def apply(
        self, df: DataFrame, include_raw: bool = False, clean: bool = True
    ) -> DataFrame:
        """Check the header and map. ``include_raw`` keeps the source row as a map of text.

        ``clean=False`` leaves cell texts as they are, for a caller that validates next:
        validation cleans them itself.
        """
        source_columns = [c for c in df.columns if not c.startswith("__")]
        self.require_columns(source_columns)
        if include_raw:
            cells = [
                piece
                for c in source_columns
                for piece in (F.lit(c), clean_text(F.col(f"`{c}`"), df.schema[c].dataType))
            ]
            df = df.withColumn("raw_source_data", F.create_map(*cells).cast(_RAW))
        mapped = df.transform(self.transform)
        lost = [c for c in df.columns if c.startswith("__") and c not in mapped.columns]
        if lost:
            raise ValueError(f"{self.name}: the mapping dropped {', '.join(lost)}")
        if not clean:
            return mapped
        return mapped.select(
            *[
                clean_text(F.col(f.name)).alias(f.name)
                if f.name in _CLEANED and isinstance(f.dataType, T.StringType)
                else F.col(f.name)
                for f in mapped.schema
            ]
        )


def renaming(
    name: str, required: Iterable[str], channel: str, fields: Mapping[str, str]
) -> SourceMapping:
    """Mapping with a fixed channel whose canonical fields are renamed source columns."""

    def transform(df: DataFrame) -> DataFrame:
        mapped = {}
        for field in CANONICAL_FIELDS:
            if field == "channel":
                mapped[field] = F.lit(channel)
            elif field == "raw_source_data":
                present = field in df.columns
                mapped[field] = F.col(field) if present else F.lit(None).cast(_RAW)
            elif field in fields:
                mapped[field] = F.col(fields[field])
            else:
                mapped[field] = F.lit(None).cast("string")
        origin = [F.col(c) for c in df.columns if c.startswith("__")]
        return df.select(*[c.alias(f) for f, c in mapped.items()], *origin)

    return SourceMapping(name, tuple(required), transform)


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


_COMMON = _same(
    "transaction_id", "customer_id", "amount", "currency", "timestamp", "card_last4", "card_type"
)

POS = renaming(
    "POS",
    POS_COLUMNS,
    "POS",
    _COMMON
    | _same("location", "merchant_id", "payment_method", "authorization_code", "response_code"),
)
ATM = renaming(
    "ATM",
    ATM_COLUMNS,
    "ATM",
    _COMMON | _same("terminal_id", "response_code") | {"payment_method": "transaction_type"},
)
ONLINE = renaming(
    "ONLINE_BANKING",
    ONLINE_COLUMNS,
    "ONLINE_BANKING",
    _COMMON
    | _same("merchant_id")
    | {"payment_method": "channel", "response_code": "transaction_status"},
)

DEFAULT_MAPPINGS: dict[str, SourceMapping] = {"pos": POS, "atm": ATM, "online": ONLINE}


def register(
    registry: Mapping[str, SourceMapping], key: str, mapping: SourceMapping
) -> dict[str, SourceMapping]:
    """A registry with a mapping added or replaced under the lower-cased key."""
    if not isinstance(mapping, SourceMapping):
        raise TypeError(f"{mapping!r} is not a SourceMapping")
    return {**registry, key.lower(): mapping}
