"""Two-source reconciliation: uniqueness guard + full outer join + classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycheck import fixed
from tallycheck.functions.text import composite_key
from tallycheck.operators.lookup import flag_in


class DuplicateKeyError(RuntimeError):
    """A comparison key occurs more than once on one side: joining would
    silently multiply rows."""


def duplicate_keys(sides: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """(SIDE, *keys) for every key that occurs more than once on a side.

    ``groupBy(keys).count()`` aggregates map-side first, so a hot key costs one
    row per map task, not one row per record."""
    frames = [df.groupBy(*keys).count().filter(F.col("count") > 1)
              .select(F.lit(side).alias("SIDE"), *keys)
              for side, df in sides.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def assert_unique(sides: Mapping[str, DataFrame], keys: Sequence[str], sample: int = 5) -> None:
    """One job over all sides; raise :class:`DuplicateKeyError` for the first
    side (in the given order) that repeats a key, with the number of repeated
    keys and the first ``sample`` of them in key order."""
    dups = duplicate_keys(sides, keys)
    counts = {r["SIDE"]: r["count"] for r in dups.groupBy("SIDE").count().collect()}
    for side in sides:
        n = counts.get(side, 0)
        if n:
            rows = dups.filter(F.col("SIDE") == side).orderBy(*keys).limit(sample).collect()
            shown = ["|".join("" if r[k] is None else str(r[k]) for k in keys) for r in rows]
            raise DuplicateKeyError(f"{side}: {n} keys occur more than once, first of them: {', '.join(shown)}")


def _matched_rows(csv: DataFrame, qr: DataFrame, keys: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """The full outer join of two sides whose keys are unique, as one aggregation of
    both: rows are combined by key before the only shuffle, so a hot key is one row a
    task, and nothing is sorted. A key that occurs twice on a side fails the job."""
    sides = {"CSV": csv.select(*keys, *[F.col(c).alias(f"_csv_{c}") for c in carry], "CSV_VOTES", F.lit(True).alias("_csv")),
             "QR": qr.select(*keys, *[F.col(c).alias(f"_qr_{c}") for c in carry], "QR_VOTES", F.lit(True).alias("_qr"))}
    both = sides["CSV"].unionByName(sides["QR"], allowMissingColumns=True)
    values = [f"_csv_{c}" for c in carry] + [f"_qr_{c}" for c in carry] + ["CSV_VOTES", "QR_VOTES"]
    g = both.groupBy(*keys).agg(F.count("_csv").alias("_csv_rows"), F.count("_qr").alias("_qr_rows"),
                                *[F.max(c).alias(c) for c in values])
    once = F.lit(True)
    for side, n in (("QR", "_qr_rows"), ("CSV", "_csv_rows")):
        parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
        message = F.concat(F.lit(f"{side}: key occurs more than once: "), composite_key(*parts))
        once = F.when(F.col(n) <= 1, once).otherwise(F.raise_error(message).cast("boolean"))
    return g.filter(once).withColumns({"_csv": F.col("_csv_rows") > 0, "_qr": F.col("_qr_rows") > 0})


def _joined_rows(csv: DataFrame, qr: DataFrame, keys: Sequence[str], carry: Sequence[str]) -> DataFrame:
    left = csv.select(*keys, *[F.col(c).alias(f"_csv_{c}") for c in carry], "CSV_VOTES", F.lit(True).alias("_csv"))
    right = qr.select(*keys, *[F.col(c).alias(f"_qr_{c}") for c in carry], "QR_VOTES", F.lit(True).alias("_qr"))
    return left.join(right, keys, "full_outer")


def classify(csv_exists: Column, qr_exists: Column, in_scope: Column,
             csv_votes: Column, qr_votes: Column) -> tuple[Column, Column]:
    """(COMPARISON_STATUS, COMPARISON_REASON) of one joined row."""
    both = csv_exists & qr_exists
    missing = csv_votes.isNull() | qr_votes.isNull()
    status = (F.when(both & missing, F.lit(fixed.MISMATCH))
              .when(both & (csv_votes == qr_votes), F.lit(fixed.MATCHED))
              .when(both, F.lit(fixed.MISMATCH))
              .when(csv_exists, F.lit(fixed.CSV_ONLY))
              .otherwise(F.lit(fixed.QR_ONLY)))
    reason = (F.when(both & missing, F.lit(fixed.MISSING_VOTE_VALUE))
              .when(both & (csv_votes == qr_votes), F.lit(fixed.VOTES_EQUAL))
              .when(both, F.lit(fixed.VOTES_DIFFER))
              .when(csv_exists & in_scope, F.lit(fixed.QR_MISSING_IN_SCOPE))
              .when(csv_exists, F.lit(fixed.CSV_OUTSIDE_SCOPE))
              .otherwise(F.lit(fixed.CSV_CHOICE_MISSING)))
    return status, reason


def status_sort(status: Column) -> Column:
    out = None
    for i, s in enumerate(fixed.STATUSES, start=1):
        out = (F.when(status == s, F.lit(i)) if out is None else out.when(status == s, F.lit(i)))
    return out.otherwise(F.lit(None).cast("int"))


def reconcile(csv: DataFrame, qr: DataFrame, keys: Sequence[str], *,
              csv_votes: str, qr_votes: str,
              scope: DataFrame | None = None, scope_on: str | None = None, scope_key: str | None = None,
              carry: Sequence[str] = (), guard: str = "inline",
              environment: str = fixed.PRODUCTION) -> DataFrame:
    """Full outer join of two sources on ``keys`` explaining every row.

    ``csv`` rows with a null key part are left out (their key would be null);
    ``qr`` is expected to hold only valid, mapped rows. ``carry`` columns present
    on both sides are resolved from whichever side has them. The scope flag is
    ``scope_on`` (one of ``keys``) being among ``scope[scope_key]``.

    ``guard``: ``"inline"`` (default) fails the join job itself on the first
    repeated key, at no extra shuffle; ``"eager"`` runs :func:`assert_unique`
    first (one job over both sides, stopping with the number of repeated keys and
    samples before anything is joined); ``"off"`` trusts the caller.
    """
    keys = list(keys)
    csv = csv.dropna(subset=keys)
    if guard == "eager":
        assert_unique({"CSV": csv, "QR": qr}, keys)
    elif guard not in ("inline", "off"):
        raise ValueError(f"unknown guard {guard!r}")
    csv = csv.select(*keys, *carry, F.col(csv_votes).cast("bigint").alias("CSV_VOTES"))
    qr = qr.select(*keys, *carry, F.col(qr_votes).cast("bigint").alias("QR_VOTES"))
    alike = [csv.schema[k].dataType == qr.schema[k].dataType for k in keys]
    if not all(alike):  # compared as a join compares them
        kinds = dict(csv.select(*keys).limit(0).join(qr.select(*keys).limit(0), keys, "full_outer").dtypes)
        csv, qr = (df.withColumns({k: F.col(k).cast(kinds[k]) for k in keys}) for df in (csv, qr))
    j = (_joined_rows if guard == "off" else _matched_rows)(csv, qr, keys, carry)

    csv_exists = F.coalesce(F.col("_csv"), F.lit(False))
    qr_exists = F.coalesce(F.col("_qr"), F.lit(False))
    j = j.withColumns({"CSV_EXISTS": csv_exists, "QR_EXISTS": qr_exists,
                       **{c: F.coalesce(F.col(f"_csv_{c}"), F.col(f"_qr_{c}")) for c in carry}})

    if scope is not None:
        j = flag_in(j, scope, [scope_on], "IS_QR_VERIFICATION_SCOPE", [scope_key or scope_on])
    else:
        j = j.withColumn("IS_QR_VERIFICATION_SCOPE", F.lit(False))

    status, reason = classify(F.col("CSV_EXISTS"), F.col("QR_EXISTS"),
                              F.col("IS_QR_VERIFICATION_SCOPE"),
                              F.col("CSV_VOTES"), F.col("QR_VOTES"))
    both = F.col("CSV_EXISTS") & F.col("QR_EXISTS")
    j = j.withColumns({"COMPARISON_STATUS": status, "COMPARISON_REASON": reason})
    j = j.withColumns({
        "STATUS_SORT": status_sort(F.col("COMPARISON_STATUS")),
        "IS_MATCHED": F.col("COMPARISON_STATUS") == fixed.MATCHED,
        "IS_MISMATCH": F.col("COMPARISON_STATUS") == fixed.MISMATCH,
        "VOTE_DIFFERENCE": F.when(both, F.coalesce(F.col("QR_VOTES"), F.lit(0))
                                  - F.coalesce(F.col("CSV_VOTES"), F.lit(0))),
        "FINAL_COMPARISON_KEY": composite_key(*keys),
        "RECORD_SCOPE": F.lit(fixed.SCOPE_COMPARISON),
        "ENVIRONMENT": F.lit(environment),
    })
    return j.select("FINAL_COMPARISON_KEY", *keys, *carry, "COMPARISON_STATUS",
                    "COMPARISON_REASON", "STATUS_SORT", "IS_QR_VERIFICATION_SCOPE",
                    "CSV_EXISTS", "QR_EXISTS", "IS_MATCHED", "IS_MISMATCH", "CSV_VOTES",
                    "QR_VOTES", "VOTE_DIFFERENCE", "RECORD_SCOPE", "ENVIRONMENT")
