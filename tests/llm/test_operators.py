"""Every operator against its brute-force version on edge cases: nulls in any
column, empty and very long texts, ties, repeated rows, empty tables, extra
columns whose names clash with the operators' own."""

import gzip
import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from chartlake.llm import arc_warc, chat_format, decontaminate, exact_dedup, line_runs, mixing, near_dup, quality_knn, repeats, secrets_forest
from chartlake.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, hits string, size long, kept string, found string, keep_id long, text_h1 long"


def words(n, seed, vocabulary=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edge_texts():
    base = words(300, 1)
    near = base.replace(base.split()[150], "other", 1)
    passage = words(90, 2)
    return [
        None, "", " \t\n\x0b\x0c\r", "one", "one", "One two  three", "a b c d e", "A B C\tD E", base, base, base.upper(), near, f" {base}\n",
        f"{words(40, 3)}\n{passage}\n{words(30, 4)}", f"{words(35, 5)}\n{passage}", "é ü ß " * 80, "Er " * 300, "x" * 5000, "x" * 401, "y\n" * 50,
        words(20_000, 6), words(20_000, 6) + " tail", " a\u0085", "İstanbul ẞ", "common line\n\nrest " + words(8, 7), "  COMMON line \t\nmore",
    ]


def documents(spark, texts=None):
    texts = edge_texts() if texts is None else texts
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 4}", None, 0.5, "h", 3, "k", "f", 9, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3), [(r[0], r[1]) for r in rows]


def by_id(df, columns, key="doc_id"):
    rows = df.collect()
    out = {r[key]: tuple(r[c] for c in columns) for r in rows}
    assert len(out) == len(rows)
    return out


def empty(spark):
    return spark.createDataFrame([], DOCS)


# ------------------------------------------------------------ decontamination

ITEMS = [("1", words(12, 2)), ("2", "one two three"), ("3", ""), ("4", None), ("5", words(12, 2)), (None, "x y"), ("7", "--- !!")]


def hit_rows(docs, items, **kw):
    found, hits = decontaminate.find_hits(docs, items, **kw)
    n_hit, n_items, _ = decontaminate.hit_counts(hits)
    return by_id(found.select("doc_id", F.col(hits)["n_words"].alias("n"), n_hit.alias("h"), n_items.alias("i"),
                              F.sha2(F.array_join(F.col(hits)["items"], ",").cast("binary"), 256).alias("sha"), (n_hit > 0).alias("c")), ("n", "h", "i", "sha", "c"))


@pytest.mark.parametrize("block_words", [200_000, 10])
def test_decontamination_matches_brute_force(spark, block_words):
    docs, plain = documents(spark, edge_texts() + ["say ONE, two-three! again one two", words(12, 2)[3:] + " " + words(12, 2), "x y x y z"])
    items = spark.createDataFrame([(*x, "extra") for x in ITEMS], "item_id string, text string, hits string")
    assert hit_rows(docs, items, block_words=block_words) == brute.decontaminate(plain, ITEMS)


def test_suffix_automaton_on_random_words():
    r = random.Random(5)
    for _ in range(60):
        items = [(str(i), [r.choice("abc") for _ in range(r.randrange(1, 25))]) for i in range(4)]
        doc = [r.choice("abcd") for _ in range(200)]
        n, spans, met = decontaminate.Automaton(items, 6).scan(doc)
        assert n == len(doc)
        want = brute.decontaminate([(0, " ".join(doc))], [(k, " ".join(v)) for k, v in items], 6)[0]
        assert sum(b - a + 1 for a, b in spans) == want[1]
        assert len(met) == want[2]
        assert all(x[1] + 1 < y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_long_texts_are_read_in_pieces(monkeypatch):
    from chartlake.llm import common

    texts = [words(900, 1) + "\n\t" + "é" * 300 + " " + words(50, 1), "x" * 1000, " ", ""]
    whole = [(near_dup.shingles(t).tolist(), quality_knn.terms(t).tolist(), list(decontaminate.word_stream(t))) for t in texts]
    monkeypatch.setattr(common, "PIECE", 50)
    assert quality_knn.terms("ab")[:quality_knn.SHAPES].sum() == 0
    monkeypatch.setattr(decontaminate, "PIECE", 50)
    assert whole == [(near_dup.shingles(t).tolist(), quality_knn.terms(t).tolist(), list(decontaminate.word_stream(t))) for t in texts]


def test_decontamination_cuts_spans_and_drops_covered_rows(spark):
    rows = [(1, "Before, ONE two three; after", 28), (2, "one two three", 13), (3, None, None), (4, "clean", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    items = spark.createDataFrame([("a", "one two three")], "item_id string, text string")
    out = {r.doc_id: (r.text, r.n_chars) for r in decontaminate.decontaminate(docs, items, max_coverage=0.7, chars_col="n_chars").collect()}
    assert out == {1: ("Before, ; after", 15), 3: (None, None), 4: ("clean", 5)}


def test_decontamination_of_empty_tables(spark):
    docs, plain = documents(spark)
    none = spark.createDataFrame([], "item_id string, text string")
    assert all(not x[4] for x in hit_rows(docs, none).values())
    assert hit_rows(empty(spark), spark.createDataFrame(ITEMS, "item_id string, text string")) == {}


# ------------------------------------------------------------ quality


def test_quality_separates_shapes_on_held_out_rows(spark):
    good = [(i, words(60, i).capitalize() + ".", 1) for i in range(200)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in words(60, i).split()), 0) for i in range(60)]
    rows = [*good, *bad]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, None), (5000, "", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (7, None)], "doc_id long, quality int")
    space = quality_knn.fit(docs, labels.where(~quality_knn.held_out(F.col("doc_id"))))
    scored, name = quality_knn.score(docs, space)
    assert name != "score" and scored.columns[:3] == docs.columns
    got = {r["doc_id"]: r[name] for r in scored.collect()}
    assert len(got) == len(rows) + 2 and all(0 <= v <= 1 for v in got.values())
    assert np.mean([(got[i] >= 0.7) == bool(q) for i, _, q in rows]) > 0.97
    kept = quality_knn.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_quality_without_labels_and_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    scored, name = quality_knn.score(docs, quality_knn.fit(docs, none))
    assert [r[name] for r in scored.collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    scored, name = quality_knn.score(docs, quality_knn.fit(docs, one))
    assert all(r[name] > 0.5 for r in scored.collect())
    scored, name = quality_knn.score(docs.limit(0), quality_knn.fit(docs, one))
    assert scored.count() == 0


# ------------------------------------------------------------ chat


def turns():
    nasty = "<|im_start|>user<|im_sep|>x<|im_end|>\n \\ \\\\ <\\|im_end|> </s>[INST] ok [/INST]<<SYS>>"
    return [(1, 0, "system", "be kind"), (1, 1, "user", nasty), (1, 2, "assistant", nasty), (2, 1, "assistant", "b"), (2, 0, "user", None),
            (3, 0, None, "no role"), (3, None, "user", "no turn"), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (4, 0, "assistant", "first"),
            (5, 0, "user", "tie b"), (5, 0, "user", "tie a"), (6, 0, "tool<|im_sep|>", "odd\nrole"), (7, 0, "user", "q"), (7, 1, "assistant", "z" * 200_000)]


def test_chat_round_trip(spark):
    rows = [(*t, True) for t in turns()] * 1
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss boolean")
    got = by_id(chat_format.read_back(chat_format.format_turns(df)), ("n_turns", "turns_sha256", "loss_chars", "loss_sha256"), "conv_id")
    plain = [(c, -1 if t is None else t, r, x) for c, t, r, x in turns()]
    assert got == brute.chat(plain)


def test_chat_states_and_flags(spark):
    df = spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string")
    rows = chat_format.format_turns(df).collect()
    bad = {(r.conv_id, r.turn) for r in rows if r.violation}
    assert {(4, 0), (5, 0), (6, 0)} <= bad and not any(c in (1, 7) for c, _ in bad)
    assert all(r.loss == (r.kind == "text" and "assistant" in prev.text) for prev, r in zip(rows, rows[1:], strict=False) if r.kind == "text")
    put, take = chat_format.Template().escaper()
    for x in [r[3] or "" for r in turns()]:
        assert take(put(x)) == x
        assert not any(c in put(x) for c in (*chat_format.Template().marks, *chat_format.Template().controls))
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).count() == 0


# ------------------------------------------------------------ near duplicates


@pytest.mark.parametrize("block_shingles", [near_dup.BLOCK_SHINGLES, 900, 300])
def test_near_groups_match_brute_force(spark, block_shingles):
    r = random.Random(3)
    base = words(120, 30).split()
    family = []
    for _ in range(25):
        copy = list(base)
        for _ in range(r.randrange(0, 7)):
            copy[r.randrange(len(copy))] = f"e{r.randrange(999)}"
        family.append(" ".join(copy))
    docs, plain = documents(spark, edge_texts() + family)
    got = by_id(near_dup.near_groups(docs, block_shingles=block_shingles), ("n_shingles", "component_id", "kept"))
    assert got == brute.near(plain)


def test_near_groups_of_null_ids_repeats_and_nothing(spark):
    text = words(30, 1)
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (4, "other words here"), (None, "lone words in here now"), (None, None)], "doc_id long, text string")
    rows = sorted(((r.doc_id is None, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_groups(docs).collect()), key=str)
    assert (True, 26, 4, False) in rows and rows.count((False, 26, 4, True)) == 2 and (True, 0, None, True) in rows and (True, 1, None, True) in rows
    assert near_dup.near_groups(empty(spark)).count() == 0
    assert near_dup.dedup(documents(spark)[0]).columns == DOCS.replace(",", "").split()[::2]


def test_sets_that_share_a_hash_are_told_apart(spark):
    docs, plain = documents(spark)
    described = near_dup.describe(docs)
    nodes, same = near_dup.distinct_sets(described)
    assert same is described
    # two sets (documents 8 and 20 with their copies) are given one first hash
    by = {r.id: r for r in described.collect()}
    clashing = described.withColumn("node", F.when(F.col("node") == by[20].node, by[8].node).otherwise(F.col("node")))
    found, told = near_dup.distinct_sets(clashing)
    assert found.count() == nodes.count()
    after = {r.id: r.node for r in told.collect()}
    assert {after[8], after[20]} == {by[8].node, max(by[8].check, by[20].check)}
    assert all(after[i] == by[i].node for i in after if by[i].node not in (by[8].node, by[20].node))
    assert after[8] == after[9] == after[10] == after[12]


def test_posterior_floor_is_the_beta_tail():
    # the posterior is beta(m + 1, n - m + 1); integrate it on a grid
    x = np.linspace(0, 1, 200_001)
    for n in (16, 64, 128):
        floor = near_dup.posterior_floor(0.75, 1e-6, n)
        tails = []
        for m in (floor - 1, floor):
            f = x ** m * (1 - x) ** (n - m)
            tails.append(f[x >= 0.75].sum() / f.sum())
        assert tails[0] < 1e-6 <= tails[1] * 1.001


def test_components(spark):
    r = random.Random(9)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root}


# ------------------------------------------------------------ repeats


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeats_match_brute_force(spark, hot):
    passage = words(120, 40)
    more = [words(50, 41) + passage + words(50, 42), passage[:-90] + words(90, 43), words(10, 44) + passage[33:], "ab" * 250, "z" * 399, "z" * 400, "é" * 300,
            words(700, 45), words(30, 46) + words(700, 45)[100:2100] + words(30, 47) + words(700, 45)[2000:3000]]
    texts = edge_texts()[:20] + more
    docs, plain = documents(spark, texts)
    done, name = repeats.remove_repeats(docs, hot=hot)
    r = F.col(name)
    got = by_id(done.select("doc_id", r["n_bytes"].alias("n"), F.aggregate(r["spans"], F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0]).alias("g"),
                            F.size(r["spans"]).alias("s"), F.sha2(r["kept"], 256).alias("sha")), ("n", "g", "s", "sha"))
    assert got == brute.repeats(plain)


def test_a_hot_string_is_split_among_tasks(spark):
    texts = [words(30, 100 + i) + "Is onhe. " * 400 + words(30, 200 + i) for i in range(60)]
    docs, plain = documents(spark, texts)
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        done, name = repeats.remove_repeats(docs.repartition(8), hot=1)
        r = F.col(name)
        done = done.select("doc_id", r["n_bytes"].alias("n"), F.aggregate(r["spans"], F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0]).alias("g"),
                           F.size(r["spans"]).alias("s"), F.sha2(r["kept"], 256).alias("sha"))
        assert by_id(done, ("n", "g", "s", "sha")) == brute.repeats(plain)
        assert "SortMergeJoin(skew=true) [name" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_repeats_in_segments_and_small_alphabets(monkeypatch):
    r = random.Random(2)
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    for size in (1, 2, 4):
        data = np.frombuffer("".join(r.choice("abcd"[:size]) for _ in range(3000)).encode(), np.uint8)
        at, names, _ = repeats.anchors(data, 160)
        inside = [((at >= i) & (at <= i + 120)).any() for i in range(len(data) - 159)]
        assert all(inside) and len(at) == len(names)


def test_repeats_of_nothing(spark):
    done, _ = repeats.remove_repeats(empty(spark))
    assert done.count() == 0


# ------------------------------------------------------------ lines


def test_lines_match_brute_force(spark):
    texts = edge_texts() + [f"common LINE\nown {i}\n  tail\u0085 " for i in range(9)] + ["x\n" + "same\n" * 12] * 3 + ["common line\nown\n" * 10_000]
    docs, plain = documents(spark, texts)
    runs = line_runs.build_runs(docs, min_docs=10, batches=5, fanout=2)
    done = line_runs.drop_lines(docs, runs.frequent())
    got = by_id(done.select("doc_id", F.size(line_runs.lines_of(F.coalesce("text", F.lit("")))).alias("n"), F.size("line_drops").alias("d"),
                            F.sha2(F.col("line_kept").cast("binary"), 256).alias("sha")), ("n", "d", "sha"))
    assert got == brute.lines(plain)
    assert line_runs.drop_lines(empty(spark), line_runs.build_runs(empty(spark)).frequent()).count() == 0


# ------------------------------------------------------------ exact dedup


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_exact_groups_match_brute_force(spark, batches):
    docs, plain = documents(spark, edge_texts() + [" " * 9, "a  b c d e", "abcde"])
    got = by_id(exact_dedup.exact_groups(docs, batches=batches), ("keep_id", "group_size", "kept", "text_sha256"))
    assert got == brute.exact(plain)


def test_exact_dedup_keeps_one_row_of_each_group(spark):
    docs = spark.createDataFrame([(None, "a b", 1), (2, "ab", 2), (2, "ab", 2), (3, "a  b", None), (None, "lone", 5), (None, "lone", 5), (None, None, 7), (9, "", 8)],
                                 "doc_id long, text string, x_id long")
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, spark.createDataFrame([(3, "a  b", None), (None, "lone", 5), (9, "", 8)], docs.schema).collect()))
    assert exact_dedup.dedup(empty(spark)).count() == 0 and exact_dedup.exact_groups(empty(spark)).count() == 0


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.array([hashlib.sha256(str(i).encode()).digest() for i in range(5000)], "V32")
    made = exact_dedup.PerfectHash.unpack(exact_dedup.PerfectHash.build(keys).pack())
    assert sorted(made.slots(keys)) == list(range(5000))
    table = np.zeros(5000, "V32")
    table[made.slots(keys)] = keys
    strangers = np.array([hashlib.sha256(str(-i - 1).encode()).digest() for i in range(5000)], "V32")
    slot = made.slots(strangers)
    assert not (table[slot[slot >= 0]] == strangers[slot >= 0]).any()


# ------------------------------------------------------------ WARC


def test_warc_round_trip(spark):
    nasty = "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n\x1f\x8b é"
    pages = [(1, "http://a/ b", nasty), (2, None, None), (3, "u", ""), (4, "http://x/%20", nasty), (5, "u\nv", "z" * 300_000), (6, "u", "one\n\n"), (7, "u", "one\n\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    back, _ = arc_warc.convert(df)
    got = by_id(arc_warc.with_referents(back), ("payload_bytes", "payload_digest", "record_type", "refers_to"), "page_id")
    assert got == brute.warc([(p, h) for p, _, h in pages])
    for r in back.collect():
        assert r.body_digest == (r.payload_digest if r.record_type == "response" else arc_warc.digest_of(b""))
        assert r.warc_date == "2026-01-01T00:00:00Z"
    assert arc_warc.with_referents(arc_warc.convert(df.limit(0))[0]).count() == 0


def test_arc_versions_and_lengths(spark):
    page = "\n\nhttp://b 0.0.0.0 20260101000000 text/html 3\nabc"
    for version in (1, 2):
        data = arc_warc._version_block(version) + arc_warc._arc_record(version, 8, "http://a b", page.encode()) + arc_warc._arc_record(version, None, "", b"")
        rows = list(arc_warc.parse_arc(data))
        assert [(r["page_id"], r["url"], r["payload"]) for r in rows] == [(8, "http://a b", page.encode()), (None, "", b"")]
    with pytest.raises(ValueError, match="version block"):
        list(arc_warc.parse_arc(arc_warc._arc_record(1, 1, "u", b"x")))
    with pytest.raises(ValueError, match="declares"):
        list(arc_warc.parse_arc(arc_warc._version_block(1) + arc_warc._arc_record(1, 1, "u", b"x" * 50)[:-30]))
    archives = arc_warc.pages_to_arc(spark.createDataFrame([(1, "u", "x"), (None, None, None)], "page_id long, url string, html string"))
    assert sorted(bytes(r.payload) for r in arc_warc.read_arc(archives).collect()) == [b"", b"x"]


# ------------------------------------------------------------ mixing


def test_targets_are_the_water_level(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), (None, 5), ("c", 10)], "source string, source_size long")
    got = {r.source: r for r in mixing.targets(sizes).collect()}
    assert {k: r.weight for k, r in got.items()} == {"a": 1.0, "b": 2.0, "c": 3.0, None: 1.0}
    assert got[None].target == 15 and got["c"].target == 30 and got["a"].target == 300
    assert abs(got["b"].target - (1115 - 15 - 30 - 300)) < 1e-9


def test_mix_comes_near_its_targets_and_repeats_agree(spark):
    r = random.Random(4)
    rows = [(i, None if i % 50 == 0 else words(r.randrange(0, 60), i), r.choice(["a", "a", "a", "b", "c", None])) for i in range(1500)]
    rows += [(None, "x y z", "a")] * 3 + [(7, "tie tie", "b")] * 2
    docs = spark.createDataFrame([(*x, 1, "t") for x in rows], "doc_id long, text string, source string, size int, target string")
    mixed = mixing.mix(docs)
    names = mixed.columns[len(docs.columns):]
    assert mixed.columns[:5] == docs.columns and "size_" in names
    out = [tuple(x) for x in mixed.collect()]
    assert sorted(map(str, out)) == sorted(map(str, (tuple(x) for x in mixing.mix(docs.repartition(7)).collect())))
    total = {}
    for x in out:
        size, whole, target, taken = x[5:9]
        assert 0 <= taken <= 3 * size and taken % max(size, 1) == 0
        total.setdefault(x[2], [0, target, whole])[0] += taken
    for taken, target, whole in total.values():
        assert abs(taken - target) <= 30 and target <= 3 * whole
    assert out == sorted(out, key=lambda x: (x[10], x[0] is not None, x[0] or 0))
    assert mixing.mix(docs.limit(0)).count() == 0


# ------------------------------------------------------------ secrets


def test_forest_tells_keys_from_numbers(spark):
    r = random.Random(8)
    hexes = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f'{words(20, i)} token = "{hexes(40)}" {words(5, i)}', "src/a") for i in range(60)]
    rows += [(100 + i, f"{words(20, i)} {r.randrange(10**15, 10**16)} {words(5, i)} commit {hexes(40)} end", None) for i in range(60)]
    rows += [(None, None, None), (1, "", "x"), (2, "x1" * 40_000, "tests/fixture"), (2, "x1" * 40_000, "tests/fixture")]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, source string, value string")
    found = secrets_forest.scan(docs, secrets_forest.weak_labels, min_docs=5).collect()
    assert len(found) == 60 + 120 + 2
    assert np.mean([(x.score >= 0.5) == bool(x.label) for x in found]) > 0.98
    assert secrets_forest.scan(docs.limit(0), secrets_forest.weak_labels).count() == 0


def test_candidates_of_any_length_and_characters(spark):
    run = "abcdefghijKLMNOPQRSTUV"
    texts = {
        'password = "hunter2!" x': ["hunter2!"], "a secret = 'p@ssw0rd-2024';": ["p@ssw0rd-2024"], f"key {run} end": [run],
        f'token = "{run}"': [run], "db.password: s3cr&t,x\n": ["s3cr&t,x"], "?token=ab&secret=c!": ["ab", "c!"],
        '{"password": "a \\"b\\" c", "x": 1}': ['a \\"b\\" c'], '"{\\"apiKey\\": \\"k y\\"}"': ["k y"], 'set_password("x y")': ["x y"],
        'PRIVATE KEY: str = """one\ntwo"""': ["one\ntwo"], 'secret: "password=hunter2!"': ["password=hunter2!", "hunter2!", 'hunter2!"'],
        f'auth="https://h/?sig={run}"': [run, f"https://h/?sig={run}"], 'password = ""': [], 'password = "open': ["open"], "hello = 'x'": [],
        'token = "é' + "z!" * 50_000 + '"': ["é" + "z!" * 50_000], "token=" * 3000 + "x": ["token=" * 2999 + "x"], "token" * 20_000: ["token" * 20_000],
    }
    rows = secrets_forest.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {}
    for x in sorted(rows, key=lambda x: (x.id, x.ordinal)):
        found.setdefault(x.id, []).append(x.value)
        assert x.before == "" or list(texts)[x.id].count(x.before + x.value + x.after)
    for i, (text, values) in enumerate(texts.items()):
        assert sorted(found.get(i, [])) == sorted(values), text[:80]
    assert all([x.ordinal for x in rows if x.id == i] == list(range(len(v))) for i, v in found.items())


def test_short_and_digit_free_secrets_are_labelled_and_scored(spark):
    r = random.Random(9)
    kinds = ["hunter2!", "p@ssw0rd-2024", "QwErTyUiOpAsDfGhJkLzXc"]
    rows = [(i, f'{words(20, i)} password = "{kinds[i % 3]}" {words(5, i)} id {r.randrange(10**15, 10**16)} end', "src/a") for i in range(60)]
    found = secrets_forest.scan(spark.createDataFrame(rows, "doc_id long, text string, source string"), secrets_forest.weak_labels, min_docs=50).collect()
    assert {(x.value, x.label) for x in found if x.label} == {(k, 1) for k in kinds} and len(found) == 120
    assert all((x.score >= 0.5) == bool(x.label) for x in found)


def test_rare_class_is_in_the_bounded_fit(spark):
    r = random.Random(10)
    hexes = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'token = "{hexes()}"' if i % 100 == 0 else f"commit {hexes()} end", "src/a") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    featured = secrets_forest.with_features(secrets_forest.candidates(docs, path_col="source"), secrets_forest.dictionary(docs))
    labelled = featured.withColumn("label", secrets_forest.weak_labels(featured))
    found = secrets_forest.score(labelled, secrets_forest.fit(labelled, max_labelled=20)).collect()
    assert len(found) == 800 and sum(x.label for x in found) == 8
    assert all((x.score >= 0.5) == bool(x.label) for x in found)
    assert secrets_forest.fit(labelled.where("label = 1"), max_labelled=20) == 1.0


def test_quality_fit_takes_one_row_per_id(spark):
    rows = [(1, words(20 + i, i)) for i in range(30)] + [(i, words(20, 100 + i)) for i in range(2, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 5)], "doc_id long, quality int")
    spaces = [quality_knn.fit(d, labels, max_labelled=4) for d in (docs, docs.repartition(7))]
    assert sorted(spaces[0].labels) == [0, 0, 1, 1]
    one = np.stack([quality_knn.terms(min(t for i, t in rows if i == k)) for k in range(1, 5)])
    assert np.array_equal(spaces[0].scores(one), spaces[1].scores(one))


def test_altered_warc_bodies_are_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "first page"), (2, "v", "first page")], "page_id long, url string, html string")
    arc_warc.write_warc(arc_warc.to_warc(arc_warc.records_of(df.coalesce(1))), str(tmp_path / "whole"), 10)
    assert sorted(r.body_bytes for r in arc_warc.read_warc(spark, str(tmp_path / "whole")).collect()) == [0, 10]
    data = b"".join(arc_warc.gunzip(f.read_bytes()) for f in (tmp_path / "whole").glob("part-*"))
    (tmp_path / "altered").mkdir()
    (tmp_path / "altered" / "part-0.gz").write_bytes(gzip.compress(data.replace(b"first page", b"other page")))
    with pytest.raises(Exception, match="not the one its headers tell of"):
        arc_warc.read_warc(spark, str(tmp_path / "altered")).collect()
