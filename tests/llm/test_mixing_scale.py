"""Mixing with very many sources and with one id in a third of all rows."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from chartlake.llm import mixing


def level(sizes):
    """{source: target} by the rule of the contract: shares by weight, capped at three times the size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, budget, target = set(order), float(sum(sizes.values())), {}
    while left:
        unit = budget / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * unit > 3 * sizes[s]}
        if not full:
            target |= {s: weight[s] * unit for s in left}
            break
        target |= {s: 3.0 * sizes[s] for s in full}
        budget -= sum(target[s] for s in full)
        left -= full
    return target


def test_targets_of_fifty_thousand_sources(spark):
    r = random.Random(3)
    sizes = {f"s{i}": int(r.paretovariate(0.8) * 10) % 100_000 for i in range(50_000)} | {None: 77, "empty": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {x.source: x.target for x in mixing.targets(df).collect()}
    want = level(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) <= 1e-6 * max(1.0, want[s]) for s in want)


def taken(rows, target):
    """{(id, size, source): [words taken]} by walking each source in the order of the shuffle."""
    by, out = defaultdict(list), defaultdict(list)
    for i, s, n in rows:
        by[s].append((hashlib.md5(f"mix|{'' if i is None else i}|{n}".encode()).hexdigest(), i is not None, i or 0, n, i))
    for s, own in by.items():
        whole, upto = sum(x[3] for x in own), 0
        for *_, n, i in sorted(own):
            upto += n
            out[i, n, s].append(n * sum(2 * (e * whole + upto) - n <= 2 * target[s] for e in range(3)) if n else 0)
    return {k: sorted(v) for k, v in out.items()}


def test_one_id_in_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 64)
    r = random.Random(5)
    rows = [(i, r.choice(["a", "a", "b", None]), r.randrange(0, 30)) for i in range(2000)] + [(7, "a", 9)] * 700 + [(7, "a", r.randrange(3)) for _ in range(300)] + [(None, "b", 4)] * 400
    r.shuffle(rows)
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    docs = spark.createDataFrame([(i, "w " * n, s) for i, s, n in rows], "doc_id long, text string, source string").repartition(6)
    want = taken(rows, level(sizes))
    for hot in (100, 10 ** 9):  # split, and not split
        monkeypatch.setattr(mixing, "HOT_ROWS", hot)
        mixed = mixing.mix(docs)
        got = defaultdict(list)
        for x in mixed.select("doc_id", "size", "source", "taken").collect():
            got[x.doc_id, x.size, x.source].append(x.taken)
        assert {k: sorted(v) for k, v in got.items()} == want
    monkeypatch.setattr(mixing, "HOT_ROWS", 100)
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "mix_sub" in plan and mixing.mix(docs).agg(F.count(F.lit(1))).first()[0] == len(rows)
