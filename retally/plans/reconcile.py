"""Paid list (J6), accepted list (J7), reconciliation gate (J8), list mismatch (J9).

The source system runs two list queries per exam group and compares list
sizes on the client.  Here every group is handled in one set-oriented job:
the lists become grouped counts, the comparison a join of those counts with
the groups, and the list difference a full outer join keyed by (group, form).
Note the two sides are keyed differently on purpose: payments are matched by
(course, semester code) from the payment notes, applications by
(subcode, semyr_code) and, for admission, by *any* captured payment of the
purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from retally.functions.casts import to_int
from retally.functions.notes import NOTE_KEYS, note_fields
from retally.operators.gate import gate_class, gate_passes
from retally.operators.membership import is_in
from retally.plans.rejects import check_rejects, watched
from retally.sources.sinks import checkpointed
from retally.sources.tables import ExamTables
from retally.specs import APPLIED_STATUS, CAPTURED, GROUP_COLUMNS, PAID_STATUS, REPORTS, ReportSpec


PURPOSES = tuple(s.purpose for s in REPORTS.values())


def captured_payments(payment: DataFrame, *purposes: str) -> DataFrame:
    """Captured payments of the purposes (default: all four) with the note fields extracted in one parse.

    ``payment`` is the raw table or an already parsed one (``captured_forms``).
    Columns: description, pay_for, course, sem.  Payments of other purposes and
    with unreadable notes belong to no list.
    """
    if "pay_for" not in payment.columns:
        payment = payment.where(F.col("status") == CAPTURED).select("description", *note_fields("notes", NOTE_KEYS))
    return payment.where(F.col("pay_for").isin(*(purposes or PURPOSES)))


def paid_ids(payment: DataFrame, *purposes: str, strict: bool = True) -> DataFrame:
    """``captured_payments`` with the form number as ``paid_scanno``.

    Only a description of these purposes is cast: other payments carry free
    text.  The condition names the purpose, so Catalyst can not move the cast
    below the parse, ahead of the purpose test.
    """
    paid = captured_payments(payment, *purposes)
    return paid.withColumn("paid_scanno", F.when(F.col("pay_for").isin(*(purposes or PURPOSES)), to_int("description", strict)))


def captured_forms(tables: ExamTables, max_reject_share: float | None = None) -> DataFrame:
    """The captured payments of all four purposes, parsed once per set of exam tables.

    Written to the shared folder at first use; jobs that need the payments on
    several sides (gates, differences, gated runs) read the small parsed table.
    Captured payments that fit no list are counted on the way
    (``plans.rejects``); with ``max_reject_share`` a larger share fails the job.
    """
    def build() -> DataFrame:
        seen = Observation()
        rows = watched(tables["payment"], seen).select("description", *NOTE_KEYS)
        forms = checkpointed(tables.spark, captured_payments(rows), "captured")
        check_rejects(seen, max_reject_share)
        return forms

    return tables.once("captured_forms", build)


def paid_list(payment: DataFrame, purpose: str | None = None) -> DataFrame:
    """Distinct paid form numbers per (pay_for, course, sem) — every group's list at once."""
    return (captured_payments(payment, *([purpose] if purpose else []))
            .select("pay_for", "course", "sem", "description").distinct())


def paid_counts(payment: DataFrame, purpose: str | None = None) -> DataFrame:
    """Size of each paid list: its distinct rows, a NULL description included.

    The distinct runs on a key that includes the description, so one hot group
    is spread over many shuffle partitions before it is counted.
    """
    return paid_list(payment, purpose).groupBy("pay_for", "course", "sem").agg(F.count(F.lit(1)).alias("paid_n"))


def accepted_applications(applications: DataFrame, payment: DataFrame, purpose: str,
                          strict: bool = True) -> DataFrame:
    """Applications paid in the form and applied for, whose form number has a
    captured payment of ``purpose`` (any course, any semester)."""
    accepted = applications.where((F.col("payment_status") == PAID_STATUS)
                                  & (F.col("retotaling_status") == APPLIED_STATUS))
    return is_in(accepted, "scanno", paid_ids(payment, purpose, strict=strict), "paid_scanno")


def accepted_list(applications: DataFrame, payment: DataFrame, purpose: str, strict: bool = True) -> DataFrame:
    """Form numbers (not de-duplicated) per (subcode, semyr_code) — every group's list at once."""
    return accepted_applications(applications, payment, purpose, strict).select(
        F.lit(purpose).alias("pay_for"), "subcode", "semyr_code", "scanno")


def accepted_counts(applications: DataFrame, payment: DataFrame, purpose: str, strict: bool = True) -> DataFrame:
    return (accepted_applications(applications, payment, purpose, strict)
            .groupBy("subcode", "semyr_code")
            .agg(F.count(F.lit(1)).alias("accepted_n"))
            .select(F.lit(purpose).alias("pay_for"), "subcode", "semyr_code", "accepted_n"))


def accepted_for_purposes(pairs: list[tuple[DataFrame, str]], payment: DataFrame,
                          strict: bool = True) -> DataFrame:
    """Accepted applications of several (application table, purpose) pairs in one pass.

    The application tables are tagged with their purpose and unioned, and meet
    the payments, parsed once, in one join with the distinct (purpose, form
    number) keys.  An inner join on distinct keys is the semi join the source
    states, but stays above the union; a semi join would be copied into each
    branch together with the payment parse.
    Columns: pay_for, subcode, semyr_code, scanno.
    """
    return _with_payment(applied_for_purposes(pairs), [p for _, p in pairs], payment, strict)


def applied_for_purposes(pairs: list[tuple[DataFrame, str]]) -> DataFrame:
    """Applications paid in the form and applied for, tagged with their purpose."""
    apps = None
    for df, purpose in pairs:
        part = (df.where((F.col("payment_status") == PAID_STATUS) & (F.col("retotaling_status") == APPLIED_STATUS))
                .select(F.lit(purpose).alias("pay_for"), "subcode", "semyr_code", "scanno"))
        apps = part if apps is None else apps.unionByName(part)
    return apps


def _with_payment(apps: DataFrame, purposes: list[str], payment: DataFrame, strict: bool) -> DataFrame:
    paid = (paid_ids(payment, *purposes, strict=strict)
            .select(F.col("pay_for").alias("_pf"), F.col("paid_scanno").alias("_pid"))
            .where(F.col("_pid").isNotNull()).distinct())
    # Columns of few values make a file a tenth of its rows or less, and the planner judges by the file: keys it takes for
    # 10 MB are 900 MB in every task of a broadcast join.  Sorted, they take a partition's share and can be spilled.
    return (apps.join(paid.hint("merge"), (F.col("pay_for") == F.col("_pf")) & (F.col("scanno") == F.col("_pid")))
            .select("pay_for", "subcode", "semyr_code", "scanno"))


def accepted_counts_for_purposes(pairs: list[tuple[DataFrame, str]], payment: DataFrame,
                                 strict: bool = True) -> DataFrame:
    return (accepted_for_purposes(pairs, payment, strict)
            .groupBy("pay_for", "subcode", "semyr_code")
            .agg(F.count(F.lit(1)).alias("accepted_n")))


def gate(groups: DataFrame, applications: DataFrame, payment: DataFrame, spec: ReportSpec,
         strict: bool = True, rule: str | None = None) -> DataFrame:
    """Per group: paid count, accepted count, gate class and whether the report runs.

    ``rule`` ("equal" or "unequal") replaces the report's own gate rule.

    ``groups`` has (course, subcode, semyr_code) and any extra columns (e.g.
    pub_result), which are kept.  Both counts are aggregates with one row per
    key, so the joins here are between small tables.
    """
    paid = (paid_counts(payment, spec.purpose)
            .select(F.col("course").alias("_p_course"), F.col("sem").alias("_p_sem"), "paid_n"))
    accepted = (accepted_counts(applications, payment, spec.purpose, strict)
                .select(F.col("subcode").alias("_a_subcode"), F.col("semyr_code").alias("_a_semyr"),
                        "accepted_n"))
    sem = F.concat(F.col("semyr_code"), F.lit(spec.sem_suffix))
    joined = (
        groups
        .join(paid, (F.col("course") == F.col("_p_course")) & (sem == F.col("_p_sem")), "left")
        .join(accepted, (F.col("subcode") == F.col("_a_subcode")) & (F.col("semyr_code") == F.col("_a_semyr")),
              "left")
    )
    paid_n = F.coalesce(F.col("paid_n"), F.lit(0).cast("long"))
    accepted_n = F.coalesce(F.col("accepted_n"), F.lit(0).cast("long"))
    extra = [c for c in groups.columns if c not in GROUP_COLUMNS]
    return joined.select(
        *extra, *GROUP_COLUMNS,
        paid_n.alias("paid_n"), accepted_n.alias("accepted_n"),
        gate_class(paid_n, accepted_n).alias("gate_class"),
        gate_passes(paid_n, accepted_n, rule or spec.gate).alias("passed"),
    )


def mismatch(groups: DataFrame, applications: DataFrame, payment: DataFrame, spec: ReportSpec,
             strict: bool = True) -> DataFrame:
    """Forms on one list of a group but not on the other.

    Lists are compared as sets of integers (descriptions are cast, so "0042"
    and 42 are the same form).  Columns: pay_for, group columns, scanno, side
    (``paid_only`` / ``accepted_only``).  Groups are small and joined first;
    the set comparison is keyed by (group, form), so a hot group still spreads.
    """
    g = groups.select(*GROUP_COLUMNS).distinct()
    sem = F.concat(F.col("semyr_code"), F.lit(spec.sem_suffix))
    pay = paid_ids(payment, spec.purpose, strict=strict).select(
        F.col("course").alias("_p_course"), F.col("sem").alias("_p_sem"), F.col("paid_scanno").alias("scanno"))
    paid_set = (g.join(pay, (F.col("course") == F.col("_p_course")) & (sem == F.col("_p_sem")))
                .select(*GROUP_COLUMNS, "scanno").distinct()
                .withColumn("_paid", F.lit(True)))
    acc = accepted_applications(applications, payment, spec.purpose, strict).select(
        F.col("subcode").alias("_a_subcode"), F.col("semyr_code").alias("_a_semyr"), "scanno")
    acc_set = (g.join(acc, (F.col("subcode") == F.col("_a_subcode")) & (F.col("semyr_code") == F.col("_a_semyr")))
               .select(*GROUP_COLUMNS, "scanno").distinct()
               .withColumn("_acc", F.lit(True)))
    both = paid_set.join(acc_set, [*GROUP_COLUMNS, "scanno"], "full_outer")
    return (both.where(F.col("_paid").isNull() | F.col("_acc").isNull())
            .select(F.lit(spec.purpose).alias("pay_for"), *GROUP_COLUMNS, "scanno",
                    F.when(F.col("_acc").isNull(), F.lit("paid_only")).otherwise(F.lit("accepted_only"))
                    .alias("side")))


def list_members(specs: list[ReportSpec], groups_by_layout: dict[str, DataFrame], applications: dict[str, DataFrame],
                 payment: DataFrame, strict: bool = True) -> DataFrame:
    """The distinct members of both lists of every group: pay_for, group columns, scanno, ``accepted`` (False: paid list).

    Give the parsed payments (``captured_forms``): both lists read them.  A list
    is one purpose in one group and has a number; payments meet the lists by
    purpose, course and semester with the suffix stripped (``sem = semyr_code ||
    suffix`` exactly when ``sem`` ends in the suffix and the rest equals
    ``semyr_code``), applications by purpose, subcode and semester.  Members are
    made distinct by the list's number, and the names follow afterwards.  The
    applications are written first, so that no task holds the sorts of the wide
    tables beside those of the lists.
    """
    spark = payment.sparkSession
    purposes = [s.purpose for s in specs]
    suffix_of = F.create_map(*[x for s in specs for x in (F.lit(s.purpose), F.lit(s.sem_suffix))])
    lists = checkpointed(spark, _all_lists(specs, groups_by_layout).withColumn("_list", F.monotonically_increasing_id()), "lists")

    pay = paid_ids(payment, *purposes, strict=strict)
    sem = F.col("sem")
    pay = pay.select(
        F.col("pay_for").alias("_p_for"),
        F.col("course").alias("_p_course"),
        F.when(sem.endswith(suffix_of[F.col("pay_for")]), F.expr("substring(sem, 1, length(sem) - 1)")).alias("_p_semyr"),
        F.col("paid_scanno").alias("scanno"),
    )
    paid = (lists.join(pay, (F.col("pay_for") == F.col("_p_for")) & (F.col("course") == F.col("_p_course"))
                       & (F.col("semyr_code") == F.col("_p_semyr")))
            .select("_list", "scanno", F.lit(False).alias("accepted")))

    applied = checkpointed(spark, applied_for_purposes([(applications[s.key], s.purpose) for s in specs]), "applied")
    acc = _with_payment(applied, purposes, payment, strict).select(
        F.col("pay_for").alias("_a_for"), F.col("subcode").alias("_a_subcode"), F.col("semyr_code").alias("_a_semyr"), "scanno")
    accepted = (lists.join(acc, (F.col("pay_for") == F.col("_a_for")) & (F.col("subcode") == F.col("_a_subcode"))
                           & (F.col("semyr_code") == F.col("_a_semyr")))
                .select("_list", "scanno", F.lit(True).alias("accepted")))
    return (paid.unionByName(accepted).distinct().join(lists, "_list")
            .select("pay_for", *GROUP_COLUMNS, "scanno", "accepted"))


def _all_lists(specs: list[ReportSpec], groups_by_layout: dict[str, DataFrame]) -> DataFrame:
    """Every purpose with every group of its layout."""
    purposes = F.explode(F.array(*[F.struct(F.lit(s.purpose).alias("pay_for"), F.lit(s.layout).alias("_of")) for s in specs]))
    return (_all_groups(groups_by_layout).select("*", purposes.alias("_p")).where(F.col("_p._of") == F.col("_layout"))
            .select(F.col("_p.pay_for").alias("pay_for"), *GROUP_COLUMNS))


def _all_groups(groups_by_layout: dict[str, DataFrame]) -> DataFrame:
    groups = None
    for layout, g in groups_by_layout.items():
        part = g.select(F.lit(layout).alias("_layout"), *GROUP_COLUMNS).distinct()
        groups = part if groups is None else groups.unionByName(part)
    return groups


def compared(members: DataFrame) -> DataFrame:
    """Both lists of every group as order-free digests, compared: one row per group that has a member.

    A list's digest is its size and the sums of two independent hashes of its
    members (a NULL entry is a member).  All three add up, so they are combined
    on the map side: a hot group sends one row per task.  Lists of one size whose
    sums agree are equal up to an accident of 2**-128.
    """
    def digest(side: Column, name: str) -> list[Column]:
        one, two = F.xxhash64("scanno"), F.xxhash64(F.lit(0x5BD1E995), "scanno")
        return [F.count_if(side).alias(f"{name}_size"),
                F.sum(F.when(side, one.cast("decimal(38,0)"))).alias(f"{name}_one"),
                F.sum(F.when(side, two.cast("decimal(38,0)"))).alias(f"{name}_two")]

    per_group = members.groupBy("pay_for", *GROUP_COLUMNS).agg(*digest(~F.col("accepted"), "paid"), *digest(F.col("accepted"), "accepted"))
    equal = ((F.col("paid_size") == F.col("accepted_size")) & F.col("paid_one").eqNullSafe(F.col("accepted_one"))
             & F.col("paid_two").eqNullSafe(F.col("accepted_two")))
    return per_group.select("pay_for", *GROUP_COLUMNS, "paid_size", "accepted_size", equal.alias("lists_equal"))


def list_equality(specs: list[ReportSpec], groups_by_layout: dict[str, DataFrame], applications: dict[str, DataFrame],
                  payment: DataFrame, strict: bool = True) -> DataFrame:
    """Per purpose and group: the sizes of both lists as sets and whether they are equal (two empty lists are)."""
    found = compared(list_members(specs, groups_by_layout, applications, payment, strict))
    every = _all_lists(specs, groups_by_layout)
    same = None
    for c in ("pay_for", *GROUP_COLUMNS):
        test = every[c].eqNullSafe(found[c])
        same = test if same is None else same & test
    nothing = F.lit(0).cast("long")
    return every.join(found, same, "left").select(
        *[every[c] for c in ("pay_for", *GROUP_COLUMNS)], F.coalesce("paid_size", nothing).alias("paid_size"),
        F.coalesce("accepted_size", nothing).alias("accepted_size"), F.coalesce("lists_equal", F.lit(True)).alias("lists_equal"))


def mismatch_for_purposes(specs: list[ReportSpec], groups_by_layout: dict[str, DataFrame],
                          applications: dict[str, DataFrame], payment: DataFrame,
                          strict: bool = True) -> DataFrame:
    """``mismatch`` of several reports in one pass (same columns).

    The members of both lists are written once.  Their digests tell which
    groups differ; only members of these groups meet by form number, so a group
    whose lists agree costs no comparison.
    """
    spark = payment.sparkSession
    key = ["pay_for", *GROUP_COLUMNS]
    members = checkpointed(spark, list_members(specs, groups_by_layout, applications, payment, strict), "list-members")
    unequal = checkpointed(spark, compared(members).where(~F.col("lists_equal")).select(*key), "unequal-groups")
    differing = members.join(unequal, key, "left_semi")
    sides = differing.groupBy(*key, "scanno").agg(F.count("*").alias("_n"), F.max("accepted").alias("_accepted"))
    return sides.where(F.col("_n") == 1).select(
        *key, "scanno", F.when(F.col("_accepted"), F.lit("accepted_only")).otherwise(F.lit("paid_only")).alias("side"))
