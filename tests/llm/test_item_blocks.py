"""Benchmarks of many blocks and items larger than a block."""

import brute
import pytest
from pyspark.sql import functions as F
from test_operators import documents, edge_texts, hit_rows, words

from chartlake.llm import decontaminate

LONG = words(137, 60)
ITEMS = [(str(i), words(12 + i, 70 + i)) for i in range(9)] + [("long", LONG), ("short", "one two three"), ("tiny", "x y"), ("none", "--")]


def texts():
    inside = LONG.split()
    return [*edge_texts()[:16], LONG, " ".join(inside[30:45]), " ".join(inside[120:]), " ".join(inside[:9]), " ".join(inside[127:]),
            f"{words(15, 73)} x y {words(12, 70)} one two three {words(16, 74)}", " ".join(inside[18:28])] * 2


@pytest.mark.parametrize("block_words,blocks", [(200_000, 1), (60, 5)])
def test_blocks_of_items_match_brute_force(spark, block_words, blocks):
    docs, plain = documents(spark, texts())
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert len(list(decontaminate._blocks(items, "item_id", "text", block_words, 10))) >= blocks
    assert all(sum(len(w) for _, w in b) <= max(block_words, 10) for b in decontaminate._blocks(items, "item_id", "text", block_words, 10))
    assert hit_rows(docs, items, block_words=block_words) == brute.decontaminate(plain, ITEMS)


def test_only_hits_are_written_between_blocks(spark, monkeypatch):
    docs, _ = documents(spark, texts())
    written = []
    plain = decontaminate.cut_lineage
    monkeypatch.setattr(decontaminate, "cut_lineage", lambda df: written.append(df.columns) or plain(df))
    found, hits = decontaminate.find_hits(docs, spark.createDataFrame(ITEMS, "item_id string, text string"), block_words=60)
    assert found.where(F.size(F.col(hits)["items"]) > 0).count() > 5
    assert written == [["k1", "k2", written[0][2]]]


def test_parts_of_an_item_hold_all_its_windows():
    for n in (1, 9, 10, 11, 25, 40, 41):
        w = [f"w{i}" for i in range(n)]
        for size in (10, 11, 20, 100):
            parts = list(decontaminate._item_parts(" ".join(w), size, 10))
            k = min(10, n)
            assert all(len(p) <= size and len(p) >= k for p in parts)
            assert {tuple(p[i:i + k]) for p in parts for i in range(len(p) - k + 1)} == {tuple(w[i:i + k]) for i in range(n - k + 1)}
    assert list(decontaminate._item_parts(" -- ", 10, 10)) == []
