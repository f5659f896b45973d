"""Column contracts: header normalisation, aliases, required / optional columns.

All checks here look at ``df.columns`` only (metadata on the driver): no job runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycheck.functions.text import normalize_header


class MissingRequiredColumn(RuntimeError):
    """A required column is absent: publication must be blocked."""


class HeaderCollision(ValueError):
    """Two raw headers normalise to the same name."""


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str = "string"
    required: bool = True


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    aliases: Mapping[str, str] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every column to UPPER_SNAKE_CASE; refuse two that collide."""
    new = [normalize_header(c) for c in df.columns]
    seen: dict[str, str] = {}
    for raw, n in zip(df.columns, new):
        if n.upper() in seen:
            raise HeaderCollision(f"headers {seen[n.upper()]!r} and {raw!r} both normalise to {n!r}")
        seen[n.upper()] = raw
    return df.toDF(*new)


def rename_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename alias -> target for aliases present, unless the target already exists."""
    cols = set(df.columns)
    todo = {a: t for a, t in aliases.items() if a in cols and t not in cols}
    return df.withColumnsRenamed(todo) if todo else df


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """Raise on a missing required column; add each missing optional one as a
    typed all-null column."""
    cols = set(df.columns)
    for f in contract.fields:
        if f.name not in cols and f.required:
            raise MissingRequiredColumn(f"{contract.name} has no column {f.name}, which its contract requires")
    missing = {f.name: F.lit(None).cast(f.dtype) for f in contract.fields if f.name not in cols}
    return df.withColumns(missing) if missing else df


def require(df: DataFrame, names: Sequence[str], dataset: str,
            error: type[Exception] = MissingRequiredColumn) -> None:
    """Inline required-column check (no optional handling)."""
    for n in names:
        if n not in df.columns:
            raise error(f"{dataset} has no column {n}, which is required")


def project(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    have = set(df.columns)
    return df.select(*[c for c in order if c in have])


# --- Fixed values: the election input contracts (column, type, required) ----
ELECTION_CONTRACTS: dict[str, Contract] = {
    "precincts": Contract("precincts", (
        Field("ACM_ID"), Field("PROVINCE"), Field("MUNICIPALITY"), Field("BARANGAY"),
        Field("POLLING_PLACE", required=False), Field("CLUSTERED_PRECINCT", required=False),
        Field("REGISTERED_VOTERS", "bigint"), Field("REGION", required=False),
    )),
    "candidates": Contract("candidates", (
        Field("CONTEST_CODE"), Field("CANDIDATE_CODE"), Field("CANDIDATE_NAME"),
        Field("PARTIES_CODE", required=False),
    )),
    "parties": Contract("parties", (
        Field("PARTIES_CODE"), Field("PARTIES_NAME"), Field("PARTIES_ALIAS", required=False),
    )),
    "contests": Contract("contests", (
        Field("CONTEST_CODE"), Field("CONTEST_NAME"),
        Field("NUM_SEATS", "bigint", required=False), Field("CONTEST_SCOPE", required=False),
    )),
    "results": Contract("results", (
        Field("PRECINCT_CODE"), Field("CONTEST_CODE"), Field("CANDIDATE_CODE"),
        Field("PARTIES_CODE", required=False), Field("VOTES_AMOUNT", "bigint"),
        Field("TOTALIZATION_ORDER", "bigint", required=False), Field("NUMBER_VOTERS", "bigint"),
        Field("UNDER_VOTES", "bigint"), Field("OVER_VOTES", "bigint"), Field("RECEPTION_DATE"),
    )),
    "mobile_er": Contract("mobile_er", (
        Field("ER_ID"), Field("CLUSTERED_PRECINCT_ID"), Field("IS_DUPLICATE", "boolean"),
        Field("RECEIVED_AT", "timestamp_ntz"), Field("ELECTION_DATE", required=False),
        Field("REGISTERED_VOTERS", "bigint", required=False), Field("BALLOTS_COUNTED", "bigint", required=False),
        Field("ENVIRONMENT"), Field("IS_CANONICAL", "boolean"), Field("SUBMISSION_STATUS"),
    )),
    "mobile_qr": Contract("mobile_qr", (
        Field("ER_ID"), Field("DISTRICT_CODE"), Field("CANDIDATE_NO", "bigint"), Field("VOTES", "bigint"),
        Field("QR_RACE_CODE"), Field("BALLOT_POSITION", "bigint"), Field("QR_VOTES", "bigint"),
        Field("ENVIRONMENT"), Field("VERIFICATION_SOURCE"),
    )),
    "verification_comparison": Contract("verification_comparison", (
        Field("FINAL_COMPARISON_KEY"), Field("CLUSTERED_PRECINCT_ID"), Field("CONTEST_CODE"),
        Field("CANDIDATE_CODE"), Field("CONTEST_CANDIDATE_KEY"), Field("COMPARISON_STATUS"),
        Field("COMPARISON_REASON"), Field("STATUS_SORT", "int"), Field("IS_QR_VERIFICATION_SCOPE", "boolean"),
        Field("CSV_EXISTS", "boolean"), Field("QR_EXISTS", "boolean"), Field("IS_MATCHED", "boolean"),
        Field("IS_MISMATCH", "boolean"), Field("CSV_VOTES", "bigint", required=False),
        Field("QR_VOTES", "bigint", required=False), Field("VOTE_DIFFERENCE", "bigint", required=False),
        Field("RECORD_SCOPE"), Field("ENVIRONMENT"),
    )),
}


def contract(dataset: str) -> Contract:
    """The election contract of ``dataset``; an unknown name is an error."""
    try:
        return ELECTION_CONTRACTS[dataset]
    except KeyError:
        raise ValueError(f"unknown dataset: {dataset}") from None


def ensure_columns(df: DataFrame, dataset: str) -> DataFrame:
    """:func:`enforce` with the named election contract."""
    return enforce(df, contract(dataset))
