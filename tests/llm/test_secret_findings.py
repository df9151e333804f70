"""The secret scan: candidates against a plain walk over each text, and how well a
forest trained on reviewed findings removes false positives on texts it has not seen."""

import random
import re

import pytest
from pyspark.sql import functions as F

from chartlake.llm import secrets_forest as S
from chartlake.llm.common import table
from tiny import SF_SMALL


def walk(text):
    """(value, before, after) of all candidates of a text, unordered."""
    text = (text or "").translate(dict.fromkeys(map(ord, S.BEGIN + S.NEXT + S.END), "�"))
    run, out = re.compile(S.CANDIDATE), []
    ends = 0
    found = list(run.finditer(text))
    for m, following in zip(found, [*found[1:], None]):
        out.append((m[0], text[ends:m.start()][-S.LEFT:], text[m.end():following.start() if following else None][:S.RIGHT]))
        ends = m.end()
    ends = 0
    for m in re.compile(S.CONTEXT, re.ASCII).finditer(text):
        quoted, value = m[2] is not None, m[2] if m[2] is not None else m[4]
        before = (text[ends:m.start()] + (m[0] if quoted else m[0][:len(m[0]) - len(value)]))[-S.LEFT:]
        after = (m[3] if quoted else m[5])[:S.RIGHT]
        ends = m.end()
        readings = [(value, before, after)]
        if not quoted and re.search("[\"'`]", value):
            cut = re.match("^([^\"'`]+?)\\\\*[\"'`]", value)
            head = cut[1] if cut else ""
            readings.append((head, before, (value[len(head):len(head) + S.RIGHT] + after)[:S.RIGHT]))
        out += [x for x in readings if not run.fullmatch(x[0])]
    return sorted(out)


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {}
    for x in S.candidates(docs).collect():
        got.setdefault(x.id, []).append((x.value, x.before, x.after))
    return {k: sorted(v) for k, v in got.items()}


def test_candidates_agree_with_a_walk(spark):
    r = random.Random(3)
    atoms = ["token", "api_key", "Secret", "x", " ", "=", ":", "\"", "'", "\\\"", "\n", "=>", "a1b2C3d4e5F6g7H8i9", "é", "$0", "\\1", "(", "{", ",", "&", "?", "zz-top",
             S.BEGIN, S.NEXT, S.END, "`", "\"\"\"", "q" * 20]
    texts = [None, "", *("".join(r.choice(atoms) for _ in range(r.randrange(1, 40))) for _ in range(3000))]
    texts += [x.text for x in table(spark, SF_SMALL, "documents").select("text").collect()]
    got = scanned(spark, texts)
    for i, t in enumerate(texts):
        assert got.get(i, []) == walk(t), repr(t)[:300]


def planted(n, seed=5):
    """Rows (doc_id, text, source) and reviewed findings (id, value, label)."""
    r = random.Random(seed)
    pick = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    hexes, mixed = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    prose = lambda k: " ".join(r.choice("the river ran past old stones while rain fell over quiet fields".split()) for _ in range(k))
    kinds = [
        (1, lambda: pick(mixed, 32), 'api_key = "{}"'), (1, lambda: pick(mixed, 24) + "!", "password: {}"), (1, lambda: pick(hexes, 40), "export AUTH_TOKEN={}"),
        (1, lambda: "ghk_" + pick(mixed, 30), "deploy with {} today"),
        (0, lambda: pick(hexes, 40), "commit {} merged"), (0, lambda: "https://host/" + pick("abcdefghij/", 30), "see {} for more"),
        (0, lambda: "example-" + pick("abcdef", 12), 'token = "{}"'), (0, lambda: "river-stones-quiet-fields-rain", "secret: {}"),
        (0, lambda: "x" * 24, 'password = "{}"'), (0, lambda: pick("0123456789", 18), "order {} shipped"),
    ]
    rows, findings = [], []
    for i in range(n):
        label, make, shape = kinds[i % len(kinds)]
        value = make()
        rows.append((i, f"{prose(12)} {shape.format(value)}\n{prose(8)}", "src/app" if label else r.choice(["src/app", "docs/notes", "tests/data"])))
        findings.append((i, value, label))
    return rows, findings


def test_reviewed_findings_train_a_forest_that_removes_false_positives(spark):
    rows, findings = planted(1500)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    known = spark.createDataFrame([*findings, findings[0], (None, "v", 1), (7, None, 1)], "id long, value string, label int")
    done = S.scan(docs, known, held_out=F.col("id") % 3 == 0, min_docs=20)
    unseen = [x for x in done.collect() if x.id % 3 == 0 and x.label is not None]
    hit = sum(x.score >= 0.5 and x.label == 1 for x in unseen)
    assert hit / sum(x.label == 1 for x in unseen) > 0.95  # recall
    assert hit / sum(x.score >= 0.5 for x in unseen) > 0.95  # precision
    assert done.count() == S.candidates(docs).count()  # findings reviewed twice or of nobody add no rows


def test_features_of_a_rule_fit_say_nothing_of_its_context(spark):
    """The same value in and out of a quoted assignment has equal independent features."""
    value = "a1B2c3D4e5F6g7H8i9"
    texts = [f'{p}token = "{value}"{a}' for p in ("", "the old river ") for a in ("", " and so on")]
    plain = [t.replace("token = \"", "").replace('"', "") for t in texts]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + plain)], "doc_id long, text string")
    found = {x.id: x for x in S.with_features(S.candidates(docs), S.dictionary(docs)).collect()}
    for i in range(len(texts)):
        a, b = found[i], found[i + len(texts)]
        assert [a[f] for f in S.INDEPENDENT if not f.startswith("words_")] == [b[f] for f in S.INDEPENDENT if not f.startswith("words_")]
        assert a.words_before == b.words_before
        assert (a.key_word_near, a.assigned, a.quoted) != (b.key_word_near, b.assigned, b.quoted)


@pytest.mark.parametrize("findings", [[], [(0, "a1B2c3D4e5F6g7H8i9", 1)]])
def test_one_class_of_reviewed_findings(spark, findings):
    docs = spark.createDataFrame([(0, "x a1B2c3D4e5F6g7H8i9 y", "s"), (None, None, None)], "doc_id long, text string, source string")
    known = spark.createDataFrame(findings, "id long, value string, label int")
    assert [x.score for x in S.scan(docs, known).collect()] == [1.0 if findings else 0.5]
