"""Exact dedup: plain grouping, groups across partitions, edge cases."""

import hashlib

from retally.llm.exact_dedup import drop_exact, exact_groups

SCHEMA = "doc_id long, text string, row string, run long, keep string"
WHITE = " \t\n\x0b\x0c\r"


def slow(rows):
    groups = {}
    for place, (doc, text) in enumerate(rows):
        norm = "".join(c for c in text or "" if c not in WHITE)
        groups.setdefault(norm, []).append((-len(text or ""), doc is None, doc, place))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:2] + ((m[2] or 0),))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(doc, members[0][2], len(members), k == 0, sha) for k, (_, _, doc, _) in enumerate(members)]
    return sorted(out, key=str)


def frame(spark, rows, parts=6):
    return spark.createDataFrame([(*r, "x", k, "y") for k, r in enumerate(rows)], SCHEMA).repartition(parts)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_hot_group_and_ties_across_many_partitions(spark):
    hot = "the same text for a third of all rows"
    rows = [(i, hot.replace(" ", "  " if i % 7 == 0 else " ")) for i in range(400)]
    rows += [(1000 + i, f"text {i // 2} of pairs") for i in range(300)] + [(2000, None), (2001, ""), (2002, " \n\t")]
    rows += [(3000 + i, f"{hot} {'tail ' * i}") for i in range(100)] + [(4000, "long " * 50000), (4001, "long" * 50000), (4002, "É"), (4003, "é")]
    for parts in (1, 2, 37):
        assert result(exact_groups(frame(spark, rows), parts=parts)) == slow(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "ab"), (None, "only"), (5, "c")]
    got = result(exact_groups(frame(spark, rows), parts=3))
    assert got == slow(rows)
    assert exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    assert drop_exact(spark.createDataFrame([], SCHEMA)).count() == 0


def test_kept_rows_come_with_all_their_columns(spark):
    rows = [(i, f"text {i % 20}") for i in range(200)]
    docs = frame(spark, rows)
    for parts in (2, 50):
        kept = drop_exact(docs, parts=parts)
        assert kept.columns == docs.columns and kept.schema["row"].dataType == docs.schema["row"].dataType
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in slow(rows) if r[3])
