"""Check registry -> per-check summary -> publication decision."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck import fixed
from tallycheck.sources.files import literal_table


@dataclass(frozen=True)
class Check:
    """``issues``: the problem rows. ``tally``: (table, aggregate) pairs whose sum
    is their number, for checks that look at single rows of a table. ``counted``: a
    frame with that number (``n``), for checks that can count without listing. ``parts``:
    frames that together are ``issues``, for checks that can list them piece by piece."""

    key: str
    name: str
    severity: str
    issues: DataFrame
    tally: tuple[tuple[DataFrame, Column], ...] = ()
    counted: DataFrame | None = None
    parts: tuple[DataFrame, ...] = ()


def catalogue(issues: Mapping[str, DataFrame]) -> list[Check]:
    """Attach the fixed names and severities to issue frames keyed by check key,
    in catalogue order (keys not supplied are skipped)."""
    tallies, counts, parts = (getattr(issues, x, {}) for x in ("tallies", "counts", "parts"))
    return [Check(k, n, s, issues[k], tuple(tallies.get(k, ())), counts[k]() if k in counts else None,
                  tuple(parts[k]()) if k in parts else ()) for k, n, s in fixed.CHECKS if k in issues]


#: Columns of a check's count.
COUNT_SCHEMA = "CHECK_ORDER int, QA_CHECK string, SEVERITY string, ISSUE_COUNT bigint"


def _count_parts(checks: Sequence[Check]) -> tuple[list[DataFrame], list[DataFrame]]:
    """(CHECK_ORDER, n) frames: one for each check that counts its own rows, and one
    for each table that checks on single rows look at, which share its aggregate."""
    tables: dict[int, tuple[DataFrame, list[tuple[int, Column]]]] = {}
    own, shared = [], []
    for i, c in enumerate(checks, start=1):
        for df, count in c.tally:
            tables.setdefault(id(df), (df, []))[1].append((i, count))
        if c.counted is not None:
            own.append(c.counted.select(F.lit(i).alias("CHECK_ORDER"), "n"))
        elif not c.tally:
            own.append(c.issues.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("CHECK_ORDER"), "n"))
    for df, counts in tables.values():
        one = df.agg(*[x.cast("bigint").alias(f"_t{j}") for j, (_, x) in enumerate(counts)])
        rows = F.array(*[F.struct(F.lit(i).alias("CHECK_ORDER"), F.col(f"_t{j}").alias("n"))
                         for j, (i, _) in enumerate(counts)])
        shared.append(one.select(F.inline(rows)))
    return own, shared


def issue_counts(checks: Sequence[Check]) -> DataFrame:
    """(CHECK_ORDER, QA_CHECK, SEVERITY, ISSUE_COUNT): every check counted in a
    single job. Checks on single rows share one aggregate, and so one read, of
    each table; checks that can count without listing their rows do that; the
    others are one aggregate each."""
    own, shared = _count_parts(checks)
    total = (reduce(lambda a, b: a.unionByName(b), own + shared)
             .groupBy("CHECK_ORDER").agg(F.sum("n").alias("ISSUE_COUNT")))
    label = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("CHECK_ORDER"))
    return total.select("CHECK_ORDER", label([c.name for c in checks]).alias("QA_CHECK"),
                        label([c.severity for c in checks]).alias("SEVERITY"), "ISSUE_COUNT")


def counts_apart(checks: Sequence[Check]) -> list[tuple]:
    """The rows of :func:`issue_counts`, in order (:data:`COUNT_SCHEMA`), counted now: a
    query for the checks on single rows and one for each other check. Each plan is
    small, and where a query's shuffles are deleted when it ends, the disk holds those
    of one check at a time."""
    own, shared = _count_parts(checks)
    total = dict.fromkeys(range(1, len(checks) + 1), 0)
    for part in own + ([reduce(lambda a, b: a.unionByName(b), shared)] if shared else []):
        for i, n in part.collect():
            total[i] += n
    return [(i, c.name, c.severity, total[i]) for i, c in enumerate(checks, start=1)]


def summarize(counts: DataFrame) -> DataFrame:
    """Status and action per check, then the OVERALL row: BLOCKED if any check
    is blocked, READY_WITH_WARNINGS if any is under review, else READY."""
    n, sev = F.col("ISSUE_COUNT"), F.col("SEVERITY")
    status = (F.when(n == 0, F.lit(fixed.PASS_STATUS))
              .when(sev == fixed.BLOCKING, F.lit(fixed.BLOCKED_STATUS))
              .when(sev == fixed.WARNING, F.lit(fixed.REVIEW_STATUS))
              .otherwise(F.lit(fixed.INFO_STATUS)))
    action = (F.when(n == 0, F.lit(fixed.ACTION_PASS))
              .when(sev == fixed.BLOCKING, F.lit(fixed.ACTION_BLOCKED))
              .when(sev == fixed.WARNING, F.lit(fixed.ACTION_REVIEW))
              .otherwise(F.lit(fixed.ACTION_INFO)))
    rows = counts.select("CHECK_ORDER", "QA_CHECK", "SEVERITY", "ISSUE_COUNT",
                         status.alias("STATUS"), action.alias("ACTION"))
    blocked = F.count_if(F.col("STATUS") == fixed.BLOCKED_STATUS)
    review = F.count_if(F.col("STATUS") == fixed.REVIEW_STATUS)
    tot = rows.agg(blocked.alias("_b"), review.alias("_r"), F.max("CHECK_ORDER").alias("_o"))
    overall = (F.when(F.col("_b") > 0, F.lit(fixed.OVERALL_BLOCKED))
               .when(F.col("_r") > 0, F.lit(fixed.OVERALL_WARNINGS))
               .otherwise(F.lit(fixed.OVERALL_READY)))
    o_action = (F.when(F.col("_b") > 0, F.lit(fixed.OVERALL_ACTION_BLOCKED))
                .when(F.col("_r") > 0, F.lit(fixed.OVERALL_ACTION_WARNINGS))
                .otherwise(F.lit(fixed.OVERALL_ACTION_READY)))
    last = tot.select(
        (F.coalesce(F.col("_o"), F.lit(0)) + 1).cast("int").alias("CHECK_ORDER"),
        F.lit(fixed.OVERALL_CHECK).alias("QA_CHECK"),
        F.when(F.col("_b") > 0, F.lit(fixed.BLOCKING)).otherwise(F.lit(fixed.WARNING)).alias("SEVERITY"),
        F.col("_b").alias("ISSUE_COUNT"), overall.alias("STATUS"), o_action.alias("ACTION"))
    return rows.withColumn("CHECK_ORDER", F.col("CHECK_ORDER").cast("int")).unionByName(last)


def decide(summary: DataFrame, environment: str = fixed.PRODUCTION, run_info: bool = False) -> DataFrame:
    """One-row publication gate from the per-check summary."""
    checks = summary.filter(F.col("QA_CHECK") != fixed.OVERALL_CHECK)
    st, n = F.col("STATUS"), F.col("ISSUE_COUNT")

    def cnt(s: str):
        return F.count_if(st == s).cast("bigint")

    def tot(s: str):
        return F.coalesce(F.sum(F.when(st == s, n)), F.lit(0)).cast("bigint")

    g = checks.agg(cnt(fixed.BLOCKED_STATUS).alias("BLOCKING_CHECK_COUNT"),
                   tot(fixed.BLOCKED_STATUS).alias("BLOCKING_ISSUE_COUNT"),
                   cnt(fixed.REVIEW_STATUS).alias("REVIEW_CHECK_COUNT"),
                   tot(fixed.REVIEW_STATUS).alias("REVIEW_ISSUE_COUNT"),
                   cnt(fixed.INFO_STATUS).alias("INFO_CHECK_COUNT"),
                   tot(fixed.INFO_STATUS).alias("INFO_ISSUE_COUNT"))
    b, r = F.col("BLOCKING_CHECK_COUNT") > 0, F.col("REVIEW_CHECK_COUNT") > 0
    pick = lambda x, y, z: F.when(b, F.lit(x)).when(r, F.lit(y)).otherwise(F.lit(z))
    head = []
    if run_info:
        head = [F.date_format(F.current_timestamp(), "'RUN_'yyyyMMdd'T'HHmmss'Z'").alias("RUN_ID"),
                F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
                .alias("REFRESH_TIMESTAMP_UTC")]
    return g.select(*head, F.lit(environment).alias("ENVIRONMENT"),
                    pick(fixed.OVERALL_BLOCKED, fixed.OVERALL_WARNINGS, fixed.OVERALL_READY)
                    .alias("PUBLICATION_STATUS"),
                    pick(fixed.DECISION_BLOCKED, fixed.DECISION_REVIEW, fixed.DECISION_READY)
                    .alias("PUBLICATION_DECISION"),
                    "BLOCKING_CHECK_COUNT", "BLOCKING_ISSUE_COUNT", "REVIEW_CHECK_COUNT",
                    "REVIEW_ISSUE_COUNT", "INFO_CHECK_COUNT", "INFO_ISSUE_COUNT",
                    pick(fixed.GATE_ACTION_BLOCKED, fixed.GATE_ACTION_REVIEW, fixed.GATE_ACTION_READY)
                    .alias("REQUIRED_ACTION"))


def issue_samples(checks: Sequence[Check], n: int = 5) -> DataFrame:
    """Up to ``n`` example rows per check (as JSON of texts, columns and rows in
    order) with the check's issue count and how many rows were left out. The
    limit is the feature here: a sample report.

    The checks are counted and sampled now, one after the other, and the report is a
    literal table: where a query's shuffles are deleted when it ends, the disk holds
    those of one check, or of one of its parts, at a time. A check that has to list its
    rows to count them is counted in the query that samples it."""
    known = {i for i, c in enumerate(checks) if c.counted is not None or c.tally}
    counts = dict(zip(sorted(known), (r[-1] for r in counts_apart([checks[i] for i in sorted(known)]))))
    out = []
    for i, c in enumerate(checks):
        if counts.get(i) == 0:
            continue
        cols = [F.col(x).cast("string").alias(x) for x in sorted(c.issues.columns)]
        row = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("SAMPLE_ROW")
        samples, count = [], counts.get(i, 0)
        for part in c.parts or (c.issues,):
            found = part.select(row).orderBy("SAMPLE_ROW").limit(n).select("SAMPLE_ROW", F.lit(None).cast("bigint").alias("n"))
            if i not in known:
                found = found.unionByName(part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("string").alias("SAMPLE_ROW"), "n"))
            rows = found.collect()
            samples += [r["SAMPLE_ROW"] for r in rows if r["n"] is None]
            count += sum(r["n"] or 0 for r in rows)
        first = sorted(samples, key=lambda x: x.encode())[:n]  # in the order of the bytes, as Spark sorts
        out += [(c.name, x, count, max(count - n, 0)) for x in first]
    return literal_table(SparkSession.getActiveSession() or checks[0].issues.sparkSession, out,
                         "QA_CHECK string, SAMPLE_ROW string, ISSUE_COUNT bigint, OMITTED_COUNT bigint")
