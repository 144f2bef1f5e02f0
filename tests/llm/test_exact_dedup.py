"""The digest index: any order of loads, repeats, stopped loads, hot digests, odd rows."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from estrella.llm.exact_dedup import DigestIndex, digest_rows
from estrella.session import work_path

WHITE = {ord(c): None for c in " \t\n\x0b\x0c\r"}
SCHEMA = "doc_id long, text string, digest string, row string, load string"  # three names that the operator uses


def brute(rows):
    """Rows as the operator returns them, without knowing which of two tying rows stays."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        plain = (text or "").translate(WHITE)
        groups[hashlib.sha256(plain.encode()).hexdigest()].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = Counter()
    for name, members in groups.items():
        keep = min(members)[3]
        out.update((m[3], keep, len(members), name) for m in members)
    return out, len(groups)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA).repartition(3)


def check(got, rows):
    want, groups = brute(rows)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == groups == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


ODD = [
    (5, "one two"),
    (5, "one two"),
    (5, "onetwo"),
    (None, "one  two "),
    (None, "one  two "),
    (7, None),
    (8, ""),
    (9, " \n\t\x0b\x0c\r"),
    (10, " "),  # no white space by this rule
    (11, "long " * 40_000),
    (12, "long" * 40_000),
    (13, "ONE two"),
    (14, "a\x00b"),
    (15, "🙂 é"),
    (3, "🙂é "),
]


def test_odd_rows(spark):
    rows = digest_rows(frame(spark, ODD))
    index = DigestIndex(spark, work_path(spark), 3)
    index.append(rows)
    check(index.decide(rows).collect(), ODD)


def test_empty_table(spark):
    rows = digest_rows(frame(spark, []))
    index = DigestIndex(spark, work_path(spark), 3)
    assert index.append(rows) == 0
    assert index.decide(rows).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_in_any_order(spark, seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 6))) for _ in range(300)]
    data = [(rnd.randint(1, 200), t) for t in texts] + [(1000 + i, "hot  one"[: 3 + i % 2] + "x") for i in range(200)]
    marked = [(*r, rnd.randint(1, 3)) for r in data]
    docs = spark.createDataFrame(marked, "doc_id long, text string, part int")
    rows = digest_rows(docs, docs["part"].cast("string"))
    ends = []
    for order in ("123", "312"):
        index = DigestIndex(spark, work_path(spark), 4)
        for load in order:
            index.append(rows.filter(rows["load"] == load))
        check(index.decide(rows).collect(), data)
        ends.append(Counter((r["doc_id"], r["keep_id"], r["text_sha256"]) for r in index.decide(rows).filter("kept").collect()))
    assert ends[0] == ends[1]


def test_again_stopped_and_compacted(spark):
    path = work_path(spark)
    data = [(i, f"text {i % 50}" + " " * (i % 7)) for i in range(400)]
    rows = digest_rows(frame(spark, data))
    index = DigestIndex(spark, path, 4)
    assert index.append(rows) == 50
    assert index.append(rows) == 0  # the same load again
    worse = digest_rows(frame(spark, [(1, "text 1")]))
    better = digest_rows(frame(spark, [(900, "text    1" + " " * 30), (901, "new")]))
    assert index.append(worse) == 0
    assert index.append(better) == 2
    # a load that lost a part on the way: the rest is found missing and appended
    half = DigestIndex(spark, work_path(spark), 4)
    half.append(rows.filter("doc_id < 20"))
    half.append(rows)
    check(half.decide(rows).collect(), data)
    index.compact()
    assert index.rows().count() == 51
    again = DigestIndex(spark, path)
    assert (again.generation, again.buckets) == (2, 4)
    assert again.append(rows) == 0
    stands = {r["doc_id"] for r in again.rows().collect()}
    assert {900, 901} <= stands


def test_index_side_is_neither_shuffled_nor_sorted(spark):
    rows = digest_rows(frame(spark, [(i, f"t{i % 90}") for i in range(500)]))
    index = DigestIndex(spark, work_path(spark), 4)
    index.append(rows)
    before = {n: spark.conf.get(n) for n in ("spark.sql.shuffle.partitions", "spark.sql.legacy.bucketedTableScan.outputOrdering")}
    with index._bucketed():
        plan = index._unknown(rows)._jdf.queryExecution().executedPlan().toString()
    assert before == {n: spark.conf.get(n) for n in before}
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Bucketed: true" in plan
    # one exchange and its two sorts belong to the load; the index is read as it lies
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 2
    files = [r["f"] for r in index.rows().selectExpr("input_file_name() f").distinct().collect()]
    assert len(files) == 4
