"""The election configuration: clean seven all-text sources, build the ballot
lookup, reconcile transmitted results against mobile QR returns, roll up the
dashboards, run the 20 checks and decide on publication.

Every function takes and returns DataFrames, so the same jobs run on CSV input
(:func:`run`) and on any other all-text frame with the same headers.

Column names are upper case throughout: Spark resolves names case-insensitively,
so the lower-case twins some sources carry would collide with their upper-case
originals; one name per column is kept.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck import fixed
from tallycheck.contracts import (
    ELECTION_CONTRACTS,
    MissingRequiredColumn,
    enforce,
    normalize_headers,
    project,
    rename_aliases,
    require,
)
from tallycheck.functions import (
    classify_in,
    is_active,
    clean_text,
    composite_key,
    lenient_key,
    match_name,
    parse_first,
    parse_flag,
    parse_instant,
    repair_unclosed_paren,
    whole_number,
)
from tallycheck.operators import checks as C
from tallycheck.operators import gate, rollups
from tallycheck.operators.lookup import canonical_join
from tallycheck.operators.reconcile import assert_unique, reconcile
from tallycheck.session import configure, deletes_shuffles, shared_folder
from tallycheck.sources.files import (
    MissingReference,
    _exists,
    empty_table,
    literal_table,
    read_text_csv,
    read_with_policy,
)
from tallycheck.sources.sinks import Publication, write_table

log = logging.getLogger(__name__)

KEYS = ["CLUSTERED_PRECINCT_ID", "CONTEST_CODE", "CANDIDATE_CODE"]


def data_status(environment: str) -> str:
    return fixed.DATA_STATUS_PRODUCTION if environment == fixed.PRODUCTION else fixed.DATA_STATUS_OTHER


# --------------------------------------------------------------------------- masters

def clean_precincts(raw: DataFrame) -> DataFrame:
    df = rename_aliases(normalize_headers(raw), fixed.PRECINCT_HEADER_ALIASES)
    df = enforce(df, ELECTION_CONTRACTS["precincts"])
    text = ["ACM_ID", "PROVINCE", "MUNICIPALITY", "BARANGAY", "REGION", "POLLING_PLACE", "CLUSTERED_PRECINCT"]
    df = df.withColumns({c: clean_text(c) for c in text})
    df = df.withColumn("REGISTERED_VOTERS", whole_number("REGISTERED_VOTERS"))
    return project(df, ["ACM_ID", "REGION", "PROVINCE", "MUNICIPALITY", "BARANGAY",
                        "POLLING_PLACE", "CLUSTERED_PRECINCT", "REGISTERED_VOTERS"])


def clean_candidates(raw: DataFrame) -> DataFrame:
    df = enforce(normalize_headers(raw), ELECTION_CONTRACTS["candidates"])
    df = df.withColumns({c: clean_text(c) for c in
                         ["CONTEST_CODE", "CANDIDATE_CODE", "CANDIDATE_NAME", "PARTIES_CODE"]})
    df = df.withColumn("CANDIDATE_NAME", repair_unclosed_paren("CANDIDATE_NAME"))
    df = df.withColumn("CONTEST_CANDIDATE_KEY", composite_key("CONTEST_CODE", "CANDIDATE_CODE"))
    return project(df, ["CONTEST_CODE", "CANDIDATE_CODE", "CANDIDATE_NAME", "PARTIES_CODE",
                        "CONTEST_CANDIDATE_KEY"])


def clean_contests(raw: DataFrame) -> DataFrame:
    df = enforce(normalize_headers(raw), ELECTION_CONTRACTS["contests"])
    df = df.withColumns({"CONTEST_CODE": clean_text("CONTEST_CODE"),
                         "CONTEST_NAME": clean_text("CONTEST_NAME"),
                         "NUM_SEATS": whole_number("NUM_SEATS")})
    df = df.withColumn("CONTEST_SCOPE", classify_in("CONTEST_CODE", fixed.REGION_WIDE_CONTEST_CODES,
                                                    fixed.REGION_WIDE, fixed.LOCAL_DISTRICT))
    return project(df, ["CONTEST_CODE", "CONTEST_NAME", "NUM_SEATS", "CONTEST_SCOPE"])


def clean_parties(raw: DataFrame) -> DataFrame:
    df = enforce(normalize_headers(raw), ELECTION_CONTRACTS["parties"])
    df = df.withColumns({c: clean_text(c) for c in ["PARTIES_CODE", "PARTIES_NAME", "PARTIES_ALIAS"]})
    return project(df, ["PARTIES_CODE", "PARTIES_NAME", "PARTIES_ALIAS"])


# --- Fixed values: columns of the cleaned results, in order
RESULT_COLUMNS = ["PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE", "PARTIES_CODE", "VOTES_AMOUNT",
                  "TOTALIZATION_ORDER", "NUMBER_VOTERS", "UNDER_VOTES", "OVER_VOTES", "RECEPTION_DATE",
                  "RECEPTION_DATETIME", "CONTEST_CANDIDATE_KEY", "SOURCE_FILE", "ENVIRONMENT"]


def clean_results(raw: DataFrame, source_file: str | None = "results.csv",  # None: from the input
                  environment: str = fixed.PRODUCTION) -> DataFrame:
    df = rename_aliases(normalize_headers(raw), {"PARTY_CODE": "PARTIES_CODE"})
    df = enforce(df, ELECTION_CONTRACTS["results"])
    df = df.withColumns({c: clean_text(c) for c in
                         ["PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE", "PARTIES_CODE"]})
    df = df.withColumns({c: whole_number(c) for c in
                         ["VOTES_AMOUNT", "NUMBER_VOTERS", "UNDER_VOTES", "OVER_VOTES", "TOTALIZATION_ORDER"]})
    df = df.withColumns({
        "CONTEST_CANDIDATE_KEY": composite_key("CONTEST_CODE", "CANDIDATE_CODE"),
        "RECEPTION_DATETIME": parse_first("RECEPTION_DATE"),
        "SOURCE_FILE": (F.lit(source_file) if source_file else
                        F.col("SOURCE_FILE") if "SOURCE_FILE" in df.columns else F.col("_metadata.file_name")),
        "ENVIRONMENT": F.lit(environment),
    })
    return project(df, RESULT_COLUMNS)


# --------------------------------------------------------------------------- mobile sources

ER_SCHEMA = ("ER_ID string, CLUSTERED_PRECINCT_ID string, IS_DUPLICATE string, RECEIVED_AT string, "
             "REGISTERED_VOTERS string, BALLOTS_COUNTED string, ELECTION_DATE string")
QR_SCHEMA = "ER_ID string, DISTRICT_CODE string, CANDIDATE_NO string, VOTES string"


def clean_mobile_ers(raw: DataFrame, environment: str = fixed.PRODUCTION) -> DataFrame:
    """All ER submissions (resubmissions included), typed."""
    df = normalize_headers(raw)
    require(df, ["ER_ID", "CLUSTERED_PRECINCT_ID", "IS_DUPLICATE", "RECEIVED_AT"], "mobile_er")
    df = df.withColumns({
        "ER_ID": clean_text("ER_ID"),
        "CLUSTERED_PRECINCT_ID": clean_text("CLUSTERED_PRECINCT_ID"),
        "IS_DUPLICATE": parse_flag("IS_DUPLICATE"),
        "RECEIVED_AT": parse_instant("RECEIVED_AT"),
        **{c: whole_number(c) for c in ["REGISTERED_VOTERS", "BALLOTS_COUNTED"] if c in df.columns},
    })
    df = df.withColumns({
        "ENVIRONMENT": F.lit(environment),
        "DATA_STATUS": F.lit(data_status(environment)),
        "IS_CANONICAL": F.lit(False),
        "SUBMISSION_STATUS": F.lit(fixed.SUBMISSION_ALL),
    })
    require(df, ELECTION_CONTRACTS["mobile_er"].required, "mobile_er")
    return df


def er_canonical(ers: DataFrame) -> DataFrame:
    """Canonical submissions: IS_DUPLICATE is false (null flags drop out).
    Expects :func:`clean_mobile_ers` output (ids already trimmed)."""
    return ers.filter(F.col("IS_DUPLICATE") == F.lit(False)).withColumns({
        "IS_CANONICAL": F.lit(True),
        "SUBMISSION_STATUS": F.lit(fixed.SUBMISSION_CANONICAL),
    })


def clean_mobile_qr(raw: DataFrame, environment: str = fixed.PRODUCTION) -> DataFrame:
    df = normalize_headers(raw)
    require(df, ["ER_ID", "DISTRICT_CODE", "CANDIDATE_NO", "VOTES"], "mobile_qr")
    df = df.withColumns({"ER_ID": clean_text("ER_ID"), "DISTRICT_CODE": clean_text("DISTRICT_CODE"),
                         "CANDIDATE_NO": whole_number("CANDIDATE_NO"), "VOTES": whole_number("VOTES")})
    df = df.withColumns({
        "QR_RACE_CODE": F.col("DISTRICT_CODE"),
        "BALLOT_POSITION": F.col("CANDIDATE_NO"),
        "QR_VOTES": F.col("VOTES"),
        "ENVIRONMENT": F.lit(environment),
        "VERIFICATION_SOURCE": F.lit(fixed.QR_SOURCE_LABEL),
        "DATA_STATUS": F.lit(data_status(environment)),
    })
    require(df, ELECTION_CONTRACTS["mobile_qr"].required, "mobile_qr")
    return df


def qr_canonical(qr: DataFrame, ers_canonical: DataFrame) -> DataFrame:
    """QR rows of canonical ERs only, with the ER's precinct and receipt."""
    er_cols = ["CLUSTERED_PRECINCT_ID", "RECEIVED_AT", "IS_CANONICAL", "SUBMISSION_STATUS", "ENVIRONMENT"]
    j = canonical_join(qr, ers_canonical, "ER_ID", [c for c in er_cols if c in ers_canonical.columns])
    return j.withColumns({"CLUSTERED_PRECINCT_ID": F.col("ER_CLUSTERED_PRECINCT_ID"),
                          "IS_CANONICAL": F.lit(True),
                          "SUBMISSION_STATUS": F.lit(fixed.SUBMISSION_CANONICAL)})


# --------------------------------------------------------------------------- reference tables

SCOPE_SCHEMA = "CONTEST_CODE string, SCOPE_STATUS string, SOURCE_AUTHORITY string, IS_MOCK_SCOPE boolean"


def load_scope(spark: SparkSession, raw: DataFrame | None, environment: str = fixed.PRODUCTION) -> DataFrame:
    """Active, distinct scope contests. Missing file: Production raises; other
    environments fall back to the fixed development contests (IS_MOCK_SCOPE)."""
    if raw is None:
        if environment == fixed.PRODUCTION:
            raise MissingReference("Production needs the approved scope, qr_verification_scope.csv")
        rows = [(c, "DEV_MOCK", None, True) for c in fixed.DEV_FALLBACK_SCOPE_CONTESTS]
        return literal_table(spark, rows, SCOPE_SCHEMA)
    df = normalize_headers(raw)
    require(df, ["CONTEST_CODE"], "qr_verification_scope", MissingReference)
    df = df.withColumn("CONTEST_CODE", clean_text("CONTEST_CODE"))
    if "ACTIVE" in df.columns:
        df = df.filter(is_active("ACTIVE"))
    df = df.withColumns({
        "SCOPE_STATUS": F.col("SCOPE_STATUS") if "SCOPE_STATUS" in df.columns else F.lit("VERIFIED"),
        "SOURCE_AUTHORITY": F.col("SOURCE_AUTHORITY") if "SOURCE_AUTHORITY" in df.columns else F.lit("FILE"),
        "IS_MOCK_SCOPE": F.lit(False),
    })
    # one row per contest; min() keeps the choice of attributes deterministic
    return df.groupBy("CONTEST_CODE").agg(F.min("SCOPE_STATUS").alias("SCOPE_STATUS"),
                                          F.min("SOURCE_AUTHORITY").alias("SOURCE_AUTHORITY"),
                                          F.min("IS_MOCK_SCOPE").alias("IS_MOCK_SCOPE"))


def load_region_wide(raw: DataFrame) -> DataFrame:
    df = normalize_headers(raw)
    require(df, ["CONTEST_CODE", "BALLOT_NO", "CANONICAL_BALLOT_NAME"], "ballot reference", MissingReference)
    df = df.withColumns({
        "CONTEST_CODE": clean_text("CONTEST_CODE"),
        "BALLOT_NO": whole_number("BALLOT_NO"),
        "CANONICAL_BALLOT_NAME": clean_text("CANONICAL_BALLOT_NAME"),
        "ENTRY_TYPE": clean_text("ENTRY_TYPE") if "ENTRY_TYPE" in df.columns else F.lit(None).cast("string"),
    })
    return df.dropna(subset=["CONTEST_CODE", "BALLOT_NO", "CANONICAL_BALLOT_NAME"])


DISTRICT_SCHEMA = "CONTEST_CODE string, BALLOT_POSITION bigint, CANDIDATE_CODE string, IS_MOCK_MAP boolean"


def load_district_map(spark: SparkSession, raw: DataFrame | None,
                      environment: str = fixed.PRODUCTION) -> DataFrame:
    if raw is None:
        if environment == fixed.PRODUCTION:
            raise MissingReference("Production needs the approved map, qr_district_ballot_position_map.csv")
        return literal_table(spark, [], DISTRICT_SCHEMA)
    df = normalize_headers(raw)
    require(df, ["CONTEST_CODE", "BALLOT_POSITION", "CANDIDATE_CODE"], "district map", MissingReference)
    df = df.withColumns({"CONTEST_CODE": clean_text("CONTEST_CODE"),
                         "BALLOT_POSITION": whole_number("BALLOT_POSITION"),
                         "CANDIDATE_CODE": clean_text("CANDIDATE_CODE"),
                         "IS_MOCK_MAP": F.lit(False)})
    return df.dropna(subset=["CONTEST_CODE", "BALLOT_POSITION", "CANDIDATE_CODE"])


# --- Fixed values: columns of the ballot map, in order
MAP_COLUMNS = ["CONTEST_CODE", "BALLOT_POSITION", "CANDIDATE_CODE", "CHOICE_TYPE", "MAPPING_SOURCE",
               "IS_MOCK_MAP"]


def ballot_choice_map(candidates: DataFrame, region_wide: DataFrame, district: DataFrame) -> DataFrame:
    """(contest, ballot position) -> candidate. Region-wide entries are matched
    to candidates by normalised name within the contest (unmatched keep a null
    candidate; a repeated name multiplies rows, which a check reports); district
    entries come from the approved map. Rows without a contest are dropped."""
    cand = candidates.select("CONTEST_CODE", "CANDIDATE_CODE", match_name("CANDIDATE_NAME").alias("_NAME"))
    ref = region_wide.withColumn("_NAME", match_name("CANONICAL_BALLOT_NAME"))
    rw = ref.join(cand, ["CONTEST_CODE", "_NAME"], "left").select(
        "CONTEST_CODE", F.col("BALLOT_NO").cast("string").alias("BALLOT_POSITION"), "CANDIDATE_CODE",
        F.coalesce(F.col("ENTRY_TYPE"), F.lit(fixed.CHOICE_REGION_WIDE)).alias("CHOICE_TYPE"),
        F.lit(fixed.MAPPING_SOURCE_REGION_WIDE).alias("MAPPING_SOURCE"), F.lit(False).alias("IS_MOCK_MAP"))
    dm = district.select(
        "CONTEST_CODE", F.col("BALLOT_POSITION").cast("string").alias("BALLOT_POSITION"), "CANDIDATE_CODE",
        F.lit(fixed.CHOICE_DISTRICT).alias("CHOICE_TYPE"),
        F.lit(fixed.MAPPING_SOURCE_DISTRICT).alias("MAPPING_SOURCE"),
        F.coalesce(F.col("IS_MOCK_MAP"), F.lit(False)).alias("IS_MOCK_MAP"))
    out = rw.unionByName(dm).withColumn("BALLOT_POSITION", whole_number("BALLOT_POSITION"))
    # joins and aggregates on the map drop this order again when they are planned
    return out.dropna(subset=["CONTEST_CODE"]).select(*MAP_COLUMNS).orderBy("CONTEST_CODE", "BALLOT_POSITION")


# --------------------------------------------------------------------------- verification

def build_csv_side(results: DataFrame, environment: str = fixed.PRODUCTION) -> DataFrame:
    """Transmitted side of the comparison, from a cleaned results snapshot
    (:func:`clean_results`): its codes are already trimmed (re-cleaning is a
    no-op, so it is not repeated per row)."""
    df = results.select(
        F.col("PRECINCT_CODE").alias("CLUSTERED_PRECINCT_ID"),
        F.col("CONTEST_CODE").alias("CSV_CONTEST_CODE"),
        F.col("CANDIDATE_CODE").alias("CSV_CANDIDATE_CODE"),
        "CONTEST_CANDIDATE_KEY", F.col("VOTES_AMOUNT").alias("CSV_VOTES"))
    return df.select(
        composite_key("CLUSTERED_PRECINCT_ID", "CSV_CONTEST_CODE", "CSV_CANDIDATE_CODE").alias("COMPARISON_KEY"),
        "*", F.lit(True).alias("CSV_EXISTS"), F.lit(fixed.CSV_SOURCE_LABEL).alias("VERIFICATION_SOURCE"),
        F.lit(environment).alias("ENVIRONMENT"))


def build_qr_side(qr_canon: DataFrame, ballot_map: DataFrame, environment: str = fixed.PRODUCTION) -> DataFrame:
    """Map canonical QR rows to (contest, candidate) through the ballot map.
    Unmapped rows stay, with MAPPING_VALID = false, for the checks to report."""
    # codes and numbers arrive cleaned and typed from clean_mobile_qr; a text
    # position (other callers) is parsed here
    qr = qr_canon
    if dict(qr.dtypes).get("BALLOT_POSITION") == "string":
        qr = qr.withColumn("BALLOT_POSITION", whole_number("BALLOT_POSITION"))
    bmap = ballot_map.select(F.col("CONTEST_CODE").alias("QR_RACE_CODE"), "BALLOT_POSITION",
                             "CANDIDATE_CODE", "CHOICE_TYPE", "MAPPING_SOURCE")
    precinct = "ER_CLUSTERED_PRECINCT_ID" if "ER_CLUSTERED_PRECINCT_ID" in qr.columns else "CLUSTERED_PRECINCT_ID"
    m = qr.drop("CANDIDATE_CODE", "CONTEST_CODE", "CHOICE_TYPE", "MAPPING_SOURCE").join(
        bmap, ["QR_RACE_CODE", "BALLOT_POSITION"], "left")
    m = m.withColumns({"CONTEST_CODE": F.col("QR_RACE_CODE"),
                       "CLUSTERED_PRECINCT_ID": F.col(precinct)})
    m = m.withColumns({
        "CONTEST_CANDIDATE_KEY": lenient_key("CONTEST_CODE", "CANDIDATE_CODE"),
        "COMPARISON_KEY": lenient_key("CLUSTERED_PRECINCT_ID", "CONTEST_CODE", "CANDIDATE_CODE"),
        "MAPPING_VALID": (F.col("CLUSTERED_PRECINCT_ID").isNotNull() & F.col("CONTEST_CODE").isNotNull()
                          & F.col("CANDIDATE_CODE").isNotNull() & F.col("BALLOT_POSITION").isNotNull()
                          & F.col("QR_VOTES").isNotNull()),
        "QR_EXISTS": F.lit(True),
        "VERIFICATION_SOURCE": F.lit(fixed.QR_SOURCE_LABEL),
        "ENVIRONMENT": F.lit(environment),
    })
    return m


def verification_sides(csv_side: DataFrame, qr_side: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is compared of both sides: the mapped rows of the QR side."""
    csv = csv_side.withColumnsRenamed({"CSV_CONTEST_CODE": "CONTEST_CODE",
                                       "CSV_CANDIDATE_CODE": "CANDIDATE_CODE"})
    return csv, qr_side.filter(F.col("MAPPING_VALID") == F.lit(True))


def run_verification(csv_side: DataFrame, qr_side: DataFrame, scope: DataFrame, guard: str = "inline",
                     environment: str = fixed.PRODUCTION) -> DataFrame:
    """verification_comparison: one row per key present on either side."""
    csv, qr = verification_sides(csv_side, qr_side)
    out = reconcile(csv, qr, KEYS, csv_votes="CSV_VOTES", qr_votes="QR_VOTES",
                    scope=scope, scope_on="CONTEST_CODE", scope_key="CONTEST_CODE",
                    guard=guard, environment=environment)
    # both sides make it of the same two keys, which no compared row lacks: nothing to carry along
    names = [c for k in out.columns for c in ([k, "CONTEST_CANDIDATE_KEY"] if k == KEYS[-1] else [k])]
    out = out.withColumn("CONTEST_CANDIDATE_KEY", composite_key("CONTEST_CODE", "CANDIDATE_CODE")).select(*names)
    require(out, ELECTION_CONTRACTS["verification_comparison"].required, "verification_comparison")
    return out


SAFE_FIELDS = {
    "NUMBER_VOTERS": ("N_DISTINCT_VOTERS", "NUMBER_VOTERS_SAFE"),
    "UNDER_VOTES": ("N_DISTINCT_UNDER", "UNDER_VOTES_SAFE"),
    "OVER_VOTES": ("N_DISTINCT_OVER", "OVER_VOTES_SAFE"),
    "RECEPTION_DATETIME": ("N_DISTINCT_DATETIME", "RECEPTION_DATETIME_SAFE"),
}


def precinct_contest_summary(results: DataFrame) -> DataFrame:
    return rollups.safe_singles(results, ["PRECINCT_CODE", "CONTEST_CODE"], SAFE_FIELDS)


# --------------------------------------------------------------------------- checks

RESULT_MEASURES = ["VOTES_AMOUNT", "NUMBER_VOTERS", "UNDER_VOTES", "OVER_VOTES"]
REQUIRED = {name: c.required for name, c in ELECTION_CONTRACTS.items()}
ROW_KEYS = {
    "precincts": ["ACM_ID"],
    "candidates": ["CONTEST_CODE", "CANDIDATE_CODE"],
    "parties": ["PARTIES_CODE"],
    "contests": ["CONTEST_CODE"],
    "results": ["PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE"],
}


class LazyChecks(Mapping):
    """Check key -> problem-row DataFrame, each built on first access."""

    def __init__(self, builders: dict, tallies: Mapping[str, list] | None = None, counts: Mapping[str, object] | None = None,
                 parts: Mapping[str, object] | None = None):
        self._builders = dict(builders)
        self.tallies = dict(tallies or {})  # as in gate.Check
        self.counts = dict(counts or {})  # builders of gate.Check.counted
        self.parts = dict(parts or {})  # and of gate.Check.parts
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self._built:
            self._built[key] = self._builders[key]()
        return self._built[key]

    def __setitem__(self, key: str, value) -> None:
        self._builders[key] = value if callable(value) else (lambda: value)
        self._built.pop(key, None)
        self.tallies.pop(key, None)
        self.counts.pop(key, None)
        self.parts.pop(key, None)

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def all_checks(*, precincts: DataFrame, candidates: DataFrame, contests: DataFrame, parties: DataFrame,
               results: DataFrame, ers: DataFrame, ers_canon: DataFrame, qr: DataFrame,
               ballot_map: DataFrame, scope: DataFrame, qr_side: DataFrame,
               environment: str = fixed.PRODUCTION) -> LazyChecks:
    """The 20 problem-row tables, keyed as in :data:`fixed.CHECKS`."""
    res_key = ["PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE"]
    totals = ["NUMBER_VOTERS", "UNDER_VOTES", "OVER_VOTES"]
    tables = {"precincts": precincts, "candidates": candidates, "parties": parties,
              "contests": contests, "results": results}

    def reception():
        if "RECEPTION_DATETIME" in results.columns:
            return C.rows_where(results, F.col("RECEPTION_DATETIME").isNull(),
                                ["PRECINCT_CODE", "CONTEST_CODE", "RECEPTION_DATE"],
                                fixed.UNPARSEABLE_RECEPTION_DATE)
        return C.rows_where(results, F.lit(True), ["PRECINCT_CODE"], fixed.RECEPTION_DATETIME_COLUMN_MISSING)

    wrong = lambda f: F.count_if(F.col(f).isNull() | (F.col(f) < 0))
    blank = lambda f: F.count_if(F.col(f).isNull())
    add = lambda parts: reduce(lambda x, y: x + y, parts)
    fires = lambda rules: add([(F.count_if(rule) > 0).cast("int") for _, rule in rules])
    tallies = {
        "acm_id_missing": [(precincts, blank("ACM_ID"))],
        "result_value_invalid": [(results, add([wrong(f) for f in RESULT_MEASURES]))],
        "registered_voter_invalid": [(precincts, wrong("REGISTERED_VOTERS"))],
        "required_value_blanks": [(df, add([blank(c) for c in REQUIRED[n] if c in df.columns]))
                                  for n, df in tables.items()],
        "mobile_required_values": [(ers, fires(er_rules(ers))), (qr, fires(qr_rules()))],
    }
    if "RECEPTION_DATETIME" in results.columns:
        tallies["reception_date_invalid"] = [(results, blank("RECEPTION_DATETIME"))]

    return LazyChecks({
        "result_duplicates": lambda: C.duplicate_rows(results, res_key, ["VOTES_AMOUNT"],
                                                      fixed.DUPLICATE_RESULT_KEY),
        "missing_result_precincts": lambda: C.missing_from(
            precincts, results, ["ACM_ID"], ["PRECINCT_CODE"], ["ACM_ID"],
            fixed.PRECINCT_NOT_YET_IN_RESULTS, distinct=False),
        "result_party_unmatched": lambda: C.missing_from(
            results.filter(F.col("PARTIES_CODE").isNotNull()), parties, ["PARTIES_CODE"], None,
            ["PRECINCT_CODE", "CONTEST_CODE", "PARTIES_CODE"], fixed.PARTY_CODE_NOT_IN_MASTER),
        "result_candidate_unmatched": lambda: C.missing_from(
            results, candidates, ["CONTEST_CANDIDATE_KEY"], None, [*res_key, "CONTEST_CANDIDATE_KEY"],
            fixed.CONTEST_CANDIDATE_KEY_NOT_IN_MASTER),
        "result_precinct_unmatched": lambda: C.missing_from(
            results, precincts, ["PRECINCT_CODE"], ["ACM_ID"], ["PRECINCT_CODE"], fixed.PRECINCT_NOT_IN_MASTER),
        "repeated_contest_totals": lambda: C.inconsistent_values(
            results, ["PRECINCT_CODE", "CONTEST_CODE"], totals),
        "acm_id_duplicates": lambda: C.duplicate_rows(
            precincts.filter(F.col("ACM_ID").isNotNull()), ["ACM_ID"], (), fixed.DUPLICATE_ACM_ID),
        "acm_id_missing": lambda: C.rows_where(precincts, F.col("ACM_ID").isNull(), None, fixed.MISSING_ACM_ID),
        "result_value_invalid": lambda: C.invalid_values(
            results, res_key, RESULT_MEASURES),
        "reception_date_invalid": reception,
        "registered_voter_invalid": lambda: C.null_or_negative(
            precincts, ["ACM_ID", "REGISTERED_VOTERS"], "REGISTERED_VOTERS", fixed.INVALID_REGISTERED_VOTERS),
        "required_value_blanks": lambda: C.required_blanks(
            {n: (df, REQUIRED[n], ROW_KEYS[n]) for n, df in tables.items()}),
        "mobile_required_values": lambda: mobile_rule_counts(ers, qr),
        "qr_orphan_er": lambda: C.missing_from(qr, ers, ["ER_ID"], None, ["ER_ID"], fixed.ORPHAN_QR_ER_ID),
        "multiple_canonical_er": lambda: C.count_above(
            ers_canon, "CLUSTERED_PRECINCT_ID", "ER_ID", "CANONICAL_COUNT", fixed.MULTIPLE_CANONICAL_ER_PER_PRECINCT),
        "duplicate_qr_choice": lambda: C.duplicate_rows(
            qr, ["ER_ID", "QR_RACE_CODE", "BALLOT_POSITION"], (), fixed.DUPLICATE_QR_CHOICE),
        "ballot_map_duplicate_key": lambda: C.duplicate_rows(
            ballot_map, ["CONTEST_CODE", "BALLOT_POSITION"], (), fixed.DUPLICATE_BALLOT_MAP_KEY),
        "scope_readiness": lambda: C.scope_readiness(
            scope, "CONTEST_CODE", contests, "CONTEST_CODE", ballot_map, "CONTEST_CODE",
            require_scope=environment == fixed.PRODUCTION),
        "unmapped_qr_choices": lambda: C.unmapped_choices(
            qr_side, "MAPPING_VALID", ["ER_ID", "QR_RACE_CODE", "BALLOT_POSITION"]),
        "qr_outside_scope": lambda: C.outside_scope(
            qr_side, "MAPPING_VALID", "CONTEST_CODE", scope, "CONTEST_CODE"),
    }, tallies, {
        "result_duplicates": lambda: C.duplicate_count(results, res_key, ["VOTES_AMOUNT"]),
        "repeated_contest_totals": lambda: C.inconsistent_count(results, ["PRECINCT_CODE", "CONTEST_CODE"], totals),
    }, {
        "repeated_contest_totals": lambda: [C.inconsistent_values(results, ["PRECINCT_CODE", "CONTEST_CODE"], [f]) for f in totals],
    })


def er_rules(ers: DataFrame) -> list[tuple[str, Column]]:
    rules = [(fixed.MISSING_ER_ID, F.col("ER_ID").isNull()),
             (fixed.MISSING_PRECINCT_ID, F.col("CLUSTERED_PRECINCT_ID").isNull()),
             (fixed.INVALID_IS_DUPLICATE_FLAG, F.col("IS_DUPLICATE").isNull())]
    if {"BALLOTS_COUNTED", "REGISTERED_VOTERS"} <= set(ers.columns):
        rules.append((fixed.BALLOTS_EXCEED_REGISTERED,
                      F.coalesce(F.col("BALLOTS_COUNTED") > F.col("REGISTERED_VOTERS"), F.lit(False))))
    return rules


def qr_rules() -> list[tuple[str, Column]]:
    return [(fixed.MISSING_QR_ER_ID, F.col("ER_ID").isNull()),
            (fixed.MISSING_QR_RACE_CODE, F.col("QR_RACE_CODE").isNull()),
            (fixed.INVALID_BALLOT_POSITION, F.col("BALLOT_POSITION").isNull()),
            (fixed.INVALID_QR_VOTES, F.col("QR_VOTES").isNull()),
            (fixed.NEGATIVE_QR_VOTES, F.coalesce(F.col("QR_VOTES") < 0, F.lit(False)))]


def mobile_rule_counts(ers: DataFrame, qr: DataFrame) -> DataFrame:
    return C.rule_counts(ers, "ER", er_rules(ers)).unionByName(C.rule_counts(qr, "QR", qr_rules()))


# --------------------------------------------------------------------------- full run

# --- Fixed values: input layout
INPUT_FILES = {
    "precincts": "Raw Sources/precincts.csv",
    "candidates": "Raw Sources/candidates.csv",
    "contests": "Raw Sources/contest.csv",
    "parties": "Raw Sources/parties.csv",
    "results": "Raw Sources/results.csv",
    "ers": "Raw Sources/Mobile App/election_returns.csv",
    "qr": "Raw Sources/Mobile App/qr_results.csv",
    "scope": "Reference/Verified/qr_verification_scope.csv",
    "region_wide": "Reference/Verified/comelec_ballot_choice_reference_verified.csv",
    "district": "Reference/Verified/qr_district_ballot_position_map.csv",
}


@dataclass
class RunResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    issues: dict[str, DataFrame] = field(default_factory=dict)
    summary: DataFrame | None = None
    gate: DataFrame | None = None
    decision: str | None = None
    exported: dict[str, bool] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    published: bool = False
    folder: str | None = None


@deletes_shuffles
def run(spark: SparkSession, input_root: str, output_root: str | None = None,
        environment: str = fixed.PRODUCTION, guard: str = "eager", fmt: str = "csv",
        paths: Mapping[str, str] | None = None, na_tokens: Sequence[str] = (),
        keep: int | None = None, compression: str | None = None) -> RunResult:
    """Clean, map, reconcile, roll up, check, decide; then export.

    Raises MissingRequiredColumn / MissingReference / DuplicateKeyError before
    anything is exported. The cleaned tables, the ballot map, the mapped QR rows and the
    comparison, which the rollups and checks reread, are written once to the shared
    folder and read back, column by column as needed. ``guard="eager"``: the comparison
    counts the rows of each key; if it stops on a repeated one, the repeated keys are
    listed for the error. ``na_tokens`` are null in every source. The
    tables are published together (``sinks.published`` reads them back), none if
    one of them failed; ``keep``: publications that stay in ``output_root``;
    ``compression``: of the published tables, but for the small ones. What a job
    shuffled is deleted when it ends.
    """
    configure(spark)
    p = {k: os.path.join(input_root, v) for k, v in INPUT_FILES.items()}
    p.update(paths or {})
    work = shared_folder(spark)

    def read(key: str, optional: bool = False) -> DataFrame | None:
        if not _exists(spark, p[key]):
            if optional:
                return None
            raise MissingRequiredColumn(f"source file {p[key]} is missing")
        return read_text_csv(spark, p[key], na_tokens)

    def or_empty(key: str, schema: str) -> tuple[DataFrame, bool]:
        return read_with_policy(spark, p[key], "fallback", empty_table(spark, schema), na_tokens=na_tokens)

    def kept(name: str, df: DataFrame) -> DataFrame:
        path = f"{work}/{name}"
        write_table(df, path, compression="zstd")
        return spark.read.schema(df.schema).parquet(path)

    r = RunResult()
    t = r.tables
    t["precincts_master"] = kept("precincts", clean_precincts(read("precincts")))
    t["candidates_master"] = kept("candidates", clean_candidates(read("candidates")))
    t["contests_master"] = kept("contests", clean_contests(read("contests")))
    t["parties_master"] = kept("parties", clean_parties(read("parties")))
    t["results_snapshot"] = kept("results", clean_results(read("results"), "results.csv", environment))
    (raw_er, no_er), (raw_qr, no_qr) = or_empty("ers", ER_SCHEMA), or_empty("qr", QR_SCHEMA)
    if no_er or no_qr:
        log.warning("mobile sources absent: QR verification runs with empty QR tables")
        raw_er, raw_qr = empty_table(spark, ER_SCHEMA), empty_table(spark, QR_SCHEMA)
    t["mobile_election_returns"] = kept("ers", clean_mobile_ers(raw_er, environment))
    t["mobile_election_returns_canonical"] = er_canonical(t["mobile_election_returns"])
    t["mobile_qr_results"] = kept("qr", clean_mobile_qr(raw_qr, environment))
    t["mobile_qr_results_canonical"] = qr_canonical(t["mobile_qr_results"],
                                                    t["mobile_election_returns_canonical"])

    scope = load_scope(spark, read("scope", optional=True), environment)
    region_wide = load_region_wide(read_with_policy(spark, p["region_wide"], na_tokens=na_tokens)[0])
    district = load_district_map(spark, read("district", optional=True), environment)
    bmap = kept("ballot_map", ballot_choice_map(t["candidates_master"], region_wide, district))

    csv_side = build_csv_side(t["results_snapshot"], environment)
    qr_side = kept("qr_side", build_qr_side(t["mobile_qr_results_canonical"], bmap, environment))
    inline = "inline" if guard == "eager" else guard
    try:
        comparison = kept("comparison", run_verification(csv_side, qr_side, scope, inline, environment))
    except Exception:
        if guard == "eager":  # what stopped the comparison, if it was a repeated key
            csv, qr = verification_sides(csv_side, qr_side)
            assert_unique({"CSV": csv.dropna(subset=KEYS), "QR": qr}, KEYS)
        raise
    t["verification_comparison"] = comparison

    t["dashboard_reporting_by_precinct"] = rollups.reporting_by_entity(
        t["precincts_master"], t["results_snapshot"], universe_key="ACM_ID", fact_key="PRECINCT_CODE",
        contest="CONTEST_CODE", received="RECEPTION_DATETIME", environment=environment)
    t["dashboard_verification_summary"] = rollups.status_summary(comparison, environment=environment)
    by_precinct = rollups.entity_status(comparison, environment=environment)
    t["dashboard_verification_by_precinct"] = by_precinct
    t["dashboard_verification_precinct_summary"] = rollups.kpi_summary(
        t["precincts_master"], "ACM_ID", t["mobile_election_returns_canonical"], "CLUSTERED_PRECINCT_ID",
        by_precinct, environment)
    t["dashboard_qr_timeline"] = rollups.timeline(
        t["mobile_election_returns_canonical"], entity="CLUSTERED_PRECINCT_ID", received="RECEIVED_AT",
        universe=t["precincts_master"], universe_key="ACM_ID", environment=environment)
    t["precinct_contest_summary"] = precinct_contest_summary(t["results_snapshot"])

    r.issues = all_checks(
        precincts=t["precincts_master"], candidates=t["candidates_master"], contests=t["contests_master"],
        parties=t["parties_master"], results=t["results_snapshot"], ers=t["mobile_election_returns"],
        ers_canon=t["mobile_election_returns_canonical"], qr=t["mobile_qr_results"], ballot_map=bmap,
        scope=scope, qr_side=qr_side, environment=environment)
    # The 20 rows serve the summary and the gate.
    counts = literal_table(spark, gate.counts_apart(gate.catalogue(r.issues)), gate.COUNT_SCHEMA)
    r.summary = gate.summarize(counts)
    r.gate = gate.decide(r.summary, environment, run_info=True)
    r.decision = r.gate.select("PUBLICATION_DECISION").first()[0]
    t["qa_final_summary"] = r.summary
    t["qa_publication_gate"] = r.gate
    if output_root:
        _export(r, Publication(spark, output_root, fmt), keep, compression)
    return r


# Small outputs are written as one ordered file each, in the order a dashboard reads them.
_EXPORT_ORDER = {
    "dashboard_verification_summary": ["STATUS_SORT"],
    "dashboard_verification_precinct_summary": ["STATUS_SORT"],
    "dashboard_qr_timeline": ["TIME_BUCKET"],
    "qa_final_summary": ["CHECK_ORDER"],
    "qa_publication_gate": [],
}


_EXPORT_FIRST = ("precinct_contest_summary", "dashboard_reporting_by_precinct")


def _export(r: RunResult, out: Publication, keep: int | None, compression: str | None) -> None:
    """Writes every table to the run's folder and publishes them together. A table
    that can't be written is named, with the reason, in ``failed``, and the
    publication before stays; without the gate row the run fails."""
    # what shuffles most is written while there is least of the others on the disk
    for name in sorted(r.tables, key=lambda x: x not in _EXPORT_FIRST):
        df, order = r.tables[name], _EXPORT_ORDER.get(name)
        if order is not None:
            # the small rows move to one task; the work before stays spread
            df = df.repartition(1).sortWithinPartitions(*order) if order else df.repartition(1)
        if name == "qa_final_summary":
            df = df.drop("CHECK_ORDER")  # only the rows' order is published
        r.exported[name] = out.add(name, df, compression if order is None else None) is None
    r.failed = dict(out.failed)
    if "qa_publication_gate" in out.failed:
        raise RuntimeError(f"the gate row can't be written: {out.failed['qa_publication_gate']}")
    r.published = out.publish(keep)
    r.folder = f"{out.root}/runs/{out.run}"
