"""Quality rules, lexical search and the filter audit against brute force on
edge cases: nulls in any column, empty and very long texts, ties, repeated
rows, empty tables, clashing column names."""

import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import documents, edge_texts, empty, words

from chartlake.llm import filter_audit, lexical_nra, quality_rules


def texts():
    passage = words(60, 11, 50)
    return [*edge_texts(), "WORD!! | " * 60, f"{passage} {passage}", passage + " " + words(80, 12), "a b c a b c d " + words(60, 13), "a|b & c " * 30,
            "same line here\n" * 4 + words(55, 14), words(120, 15).upper(), words(120, 15).upper(), "x " * 99, words(100, 16, 90)]


# ------------------------------------------------------------ quality rules


def test_counts_match_brute_force(spark):
    docs, plain = documents(spark, texts())
    docs = docs.withColumn("n_words", F.lit("clash")).withColumn("q_words", F.lit("clash"))
    measured, names = quality_rules.measure(docs)
    assert names["n_words"] != "n_words" and measured.columns[:len(docs.columns)] == docs.columns
    got = {r["doc_id"]: {k: r[v] for k, v in names.items()} for r in measured.collect()}
    assert got == {d: brute.quality_counts(t) for d, t in plain}


def test_windows_are_compared_as_strings(spark):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["a", "b", "cc", "dd", "e"][:2 + i % 4]) for _ in range(r.randrange(0, 40)))) for i in range(60)]
    measured, _ = quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_repeat_words for r in measured.collect()} == {d: brute.repeat_words(t.split()) for d, t in rows}


@pytest.mark.parametrize("k,n,rate", [(0, 1, 0.5), (0, 2000, 0.007), (3, 1000, 0.01), (40, 10_000, 0.005), (199, 20_000, 0.01), (7, 500, 0.01)])
def test_binomial_tail_is_exact(spark, k, n, rate):
    got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), rate).alias("p")).first().p
    assert math.isclose(got, brute.binomial_tail(k, n, rate) if k < n * rate else 1.0, rel_tol=1e-9)


def test_rules_match_brute_force(spark):
    r = random.Random(1)
    rows, marks = [], []
    for i in range(700):
        t = words(60 + i % 30, i)
        if i % 10 == 0:
            t = " | ".join(t.split())
        if i % 50 == 7:
            t = t.upper() + "!!"
        rows.append((i, "one" if i % 3 else None, t))
        if i % 10:
            marks.append((i, 1))
        elif i % 20:
            marks.append((i, 0))
    rows += [(None, "one", words(70, 5)), (3, "two", words(70, 6)), (5000, "two", None), (5001, "two", ""), (3, "one", "too short")]
    marks += [(None, 1), (4, 0), (9, None), (5000, 1)]
    r.shuffle(rows)
    docs = spark.createDataFrame([(*x, "k", 1) for x in rows], "doc_id long, lang string, text string, kept string, stratum long").repartition(5)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    for risk in (0.2, 0.5):
        out = quality_rules.apply_rules(docs, labels, risk=risk)
        names = list(brute.quality_counts(""))
        got = sorted(((x["id"], *(x[n] for n in names), x.base_failed, x.kept) for x in out.collect()), key=str)
        want = [(d, *c.values(), failed, kept) for d, c, failed, kept in brute.quality_rules(rows, marks, quality_rules.RULES, risk, 0.05)]
        assert got == sorted(want, key=str)
        assert any("symbols" in x.failed_rules for x in out.collect())


def test_false_rejections_stay_below_the_risk(spark):
    """Cutoffs chosen on one half hold on the other, where the rule rejects a known share of good rows."""
    r = random.Random(8)
    rows = [(i, "s", " ".join(["#w" if r.random() < 0.02 * (i % 20) else "w%d" % r.randrange(10 ** 6) for _ in range(60)])) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(8)
    labels = spark.createDataFrame([(i, 1) for i, *_ in rows if i % 2], "doc_id long, quality int")
    out = quality_rules.apply_rules(docs, labels, risk=0.35).where("not base_failed and id % 2 = 0")
    rejected, n = out.agg(F.avg((~F.col("kept")).cast("double")), F.count(F.lit(1))).first()
    assert n == 2000 and 0 < rejected < 0.35 / len(quality_rules.RULES) + 0.01


def test_rules_without_labels_and_rows(spark):
    docs, plain = documents(spark, texts())
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality_rules.apply_rules(docs, none).collect()
    assert len(out) == len(plain) and all(x.kept == (not x.base_failed) for x in out)
    assert quality_rules.apply_rules(empty(spark), none).count() == 0


# ------------------------------------------------------------ lexical search

QUERIES = [(1, words(12, 2)), (2, "One, two-three!"), (3, ""), (4, None), (5, "x y z w1 w2 w3 w1"), (5, "w4"), (None, "é ü w7"), (7, "--- !!"), (8, "nothingheldthis"), (9, words(400, 6))]


def found(df):
    rows = df.collect()
    out = {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("args", [{}, {"block_terms": 1}, {"shard": 3}, {"shard": 7, "block_terms": 30}])
def test_search_matches_brute_force(spark, args):
    docs, plain = documents(spark, texts() + ["w1 w2"] * 14 + ["\x00w1\x7fw2", "É w7"])
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") != 20, F.col("doc_id")))  # a null id
    plain = [(None if d == 20 else d, t) for d, t in plain]
    queries = spark.createDataFrame([(*x, 1) for x in QUERIES], "item_id long, text string, score long")
    assert found(lexical_nra.search(docs, queries, **args)) == brute.lexical(plain, QUERIES)


def test_search_on_random_words(spark, monkeypatch):
    monkeypatch.setattr(lexical_nra, "FIRST", 2)
    r = random.Random(4)
    for n in (1, 5, 300):
        docs = [(i, " ".join(f"v{int(r.paretovariate(0.7)) % 60}" for _ in range(r.randrange(1, 30)))) for i in range(n)]
        made = []
        for i, (_, t) in enumerate(docs):
            made += [(int(term[1:]), i, 1000 * c // (c + 3)) for term, c in lexical_nra.term_counts(t).items()]
        shard = lexical_nra.Shard(n, *(np.array(x, np.int64) for x in zip(*made, strict=True)))
        for _ in range(40):
            query = [(t, r.randrange(1, 50)) for t in r.sample(range(70), r.randrange(1, 9))]
            score = [0] * n
            for t, d, s in made:
                score[d] += s * dict(query).get(t, 0)
            for k, least in ((1, 1), (10, 1), (10, sorted(score)[-min(n, 4)])):
                at, scores = shard.search(query, k, max(1, least))
                bar = max(1, least, sorted(score)[-k] if n >= k else 0)
                assert dict(zip(at.tolist(), scores.tolist(), strict=True)) == {d: s for d, s in enumerate(score) if s >= bar}


def test_search_of_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one two"), ("c", "three")], "doc_id string, text string")
    queries = spark.createDataFrame([("q", "ONE")], "item_id string, text string")
    assert {r: d for (_, r), (d, _) in found(lexical_nra.search(docs, queries)).items()} == {1: "a", 2: "b", 3: None}
    assert lexical_nra.search(docs, queries.limit(0)).count() == 0
    assert lexical_nra.search(docs.limit(0), queries).count() == 0
    assert lexical_nra.search(docs.select("doc_id", F.lit(None).cast("string").alias("text")), queries).count() == 0


# ------------------------------------------------------------ filter audit


def report(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in rows}
    assert len(out) == len(rows)
    return out


def test_audit_matches_brute_force(spark):
    own = texts()
    rows = [(None if i == 8 else i % 40, [None, "", "en", "de"][i % 4], t, 7) for i, t in enumerate(own)] + [(3, "en", "one", 7), (900, "fr", own[8], 7)]
    labels = [(i, i % 2, i % 3) for i in range(0, 40, 2)] + [(5, 1, None), (5, 0, 1), (None, 1, 1), (6, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, fails long").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = report(filter_audit.audit(filter_audit.with_flags(filter_audit.failures(docs), marks)))
    assert got == brute.audit([x[:3] for x in rows], labels)
    assert len(got) == 4 * 600


def test_paths_through_the_lattice():
    for n in range(1, 7):
        reach, leave = filter_audit.path_counts(n)
        for state in range(1 << n):
            size = state.bit_count()
            assert reach[state] == math.factorial(size) and leave[state] == math.factorial(n - size)


def test_audit_of_other_filters_and_empty_tables(spark):
    counted = spark.createDataFrame([("p", m) for m in (0, 1, 2, 3, 3)], "part string, fails int")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in filter_audit.audit(counted, "XY", ()).collect()}
    assert got == {("XY", 1): (2, 3, 0, 1, 4), ("XY", 2): (1, 1, 2, 1, 4), ("YX", 1): (2, 3, 0, 1, 4), ("YX", 2): (1, 1, 2, 1, 4)}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.with_flags(filter_audit.failures(empty(spark)), none)).count() == 0
    with pytest.raises(ValueError):
        filter_audit.audit(counted, "ABCDEFGH", ())
