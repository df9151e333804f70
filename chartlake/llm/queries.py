"""The registered queries of this subpackage: opN_<name> and pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.llm import (
    arc_warc,
    chat_format,
    decontaminate,
    exact_dedup,
    filter_audit,
    lexical_nra,
    line_runs,
    mixing,
    near_dup,
    quality_knn,
    quality_rules,
    repeats,
    secrets_forest,
)
from chartlake.llm.common import remove_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn
    return add


@query()
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, hits = decontaminate.find_hits(docs, table(spark, sf_dir, "benchmark"), window=10)
    n_hit, n_items, coverage = decontaminate.hit_counts(hits)
    return found.select("doc_id", F.col(hits)["n_words"].alias("n_words"), n_hit.alias("n_hit"), n_items.alias("n_items"),
                        F.sha2(F.array_join(F.col(hits)["items"], ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    space = quality_knn.fit(docs, labels.where(~quality_knn.held_out(F.col("doc_id"))))
    scored, name = quality_knn.score(docs, space)
    return scored.select("doc_id", quality_knn.held_out(F.col("doc_id")).alias("held_out"), F.col(name).alias("score"),
                         (F.col(name) >= 0.7).cast("int").alias("predicted"))


@query()
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat_format.read_back(chat_format.format_turns(rows.unionByName(extra)))


@query()
def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_groups(table(spark, sf_dir, "documents"))


@query()
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secrets_forest.scan(docs, secrets_forest.weak_labels, held_out=quality_knn.held_out(F.col("id")),
                                features=secrets_forest.INDEPENDENT)
    return found.select(F.col("id").alias("doc_id"), "ordinal", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
                        F.length("value").cast("long").alias("n_chars"), F.round("score", 6).alias("score"), (F.col("score") >= 0.5).alias("is_secret"),
                        quality_knn.held_out(F.col("id")).alias("held_out"), "label")


OP6 = r"""
WITH d AS (SELECT doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS bigint) AS size FROM documents),
s AS (SELECT source, sum(size)::bigint AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::double AS weight FROM d GROUP BY source),
c AS (SELECT *, 3.0::double * source_size AS cap FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM s)::double - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size, least((SELECT max(level) FROM l) * weight, cap) AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix|' || coalesce(cast(d.doc_id AS varchar), '') || '|' || d.size), d.doc_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       cast(CASE WHEN size = 0 THEN 0 ELSE size * ((CASE WHEN 2 * upto - size <= 2 * target THEN 1 ELSE 0 END)
         + (CASE WHEN 2 * (source_size + upto) - size <= 2 * target THEN 1 ELSE 0 END)
         + (CASE WHEN 2 * (2 * source_size + upto) - size <= 2 * target THEN 1 ELSE 0 END)) END AS bigint) AS taken
FROM p
"""


@query(OP6)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query()
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, name = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    r = F.col(name)
    removed = F.aggregate(r["spans"], F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])
    return done.select("doc_id", r["n_bytes"].alias("n_bytes"), removed.alias("n_removed"), F.size(r["spans"]).cast("long").alias("n_spans"),
                       F.sha2(r["kept"], 256).alias("kept_sha256"))


OP8 = r"""
WITH l AS (SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::bigint AS n_lines, (count(*) FILTER (WHERE f.key IS NOT NULL))::bigint AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id
"""


@query(OP8)
def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = line_runs.build_runs(docs, min_docs=10, min_chars=1)
    done = line_runs.drop_lines(docs, runs.frequent())
    runs.remove()
    return done.select("doc_id", F.size(line_runs.lines_of(F.coalesce("text", F.lit("")))).cast("long").alias("n_lines"),
                       F.size("line_drops").cast("long").alias("n_dropped"), F.sha2(F.col("line_kept").cast("binary"), 256).alias("kept_sha256"))


OP9 = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS cp,
                  sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS h FROM documents),
w AS (SELECT doc_id, h, first_value(doc_id) OVER (PARTITION BY h ORDER BY cp DESC, doc_id NULLS LAST) AS keep_id, count(*) OVER (PARTITION BY h) AS n FROM d)
SELECT doc_id, keep_id, n::bigint AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256 FROM w
"""


@query(OP9)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query()
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back, folder = arc_warc.convert(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    digests = ("page_id", "payload_bytes", "payload_digest", "record_type")
    done = arc_warc.with_referents(back.select(*digests, "record_id", "refers_to_id")).select(*digests, "refers_to")
    remove_folder(spark, folder)  # parsed once, into a checkpoint
    return done


def _rules_sql(rules=quality_rules.RULES, risk: float = 0.05, miss: float = 0.05) -> str:
    """The operator's declared rules and grids written out as SQL."""
    def beyond(rule, cutoff):
        return f"100 * {rule.part} {'>' if rule.above else '<'} {cutoff} * {rule.whole}"

    tried = " UNION ALL ".join(
        f"SELECT lang, {i} AS rule, x.lv AS level, {list(r.grid)}[x.lv] AS cutoff, count(*) AS n, count(*) FILTER (WHERE {beyond(r, f'{list(r.grid)}[x.lv]')}) AS k "
        f"FROM hold, range(1, {len(r.grid) + 1}) AS x(lv) GROUP BY lang, x.lv" for i, r in enumerate(rules))
    rate = risk / len(rules)
    return r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF len(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) > 0] AS l FROM documents),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT r, gram FROM g GROUP BY r, gram HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM g JOIN twice USING (r, gram)) GROUP BY r),
c AS (SELECT doc_id, lang, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(regexp_extract_all(t, '[A-Z]')) AS n_upper,
             len(regexp_extract_all(t, '[!?]')) AS n_marks FROM d LEFT JOIN rep ON d.r = rep.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
hold AS (SELECT * FROM b WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1)),
tried AS (""" + tried + f"""),
certified AS (SELECT *, k < n * {rate!r} AND list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate!r}) + (n - i) * ln(1 - {rate!r})) FOR i IN range(k + 1)])
                        <= {miss!r} / ((SELECT count(DISTINCT coalesce(lang, chr(0))) FROM hold) * {len(rules)}) AS ok FROM tried),
upto AS (SELECT *, coalesce(min(level) FILTER (WHERE NOT ok) OVER (PARTITION BY lang, rule), 1000) AS stop FROM certified),
cut AS (SELECT lang, {', '.join(f'arg_max(cutoff, level) FILTER (WHERE rule = {i} AND level < stop) AS c{i}' for i in range(len(rules)))} FROM upto GROUP BY lang)
SELECT doc_id, n_words::bigint AS n_words, word_chars::bigint AS word_chars, n_symbols::bigint AS n_symbols, n_dup_lines::bigint AS n_dup_lines,
       n_repeat_words::bigint AS n_repeat_words, base_failed,
       NOT base_failed AND NOT ({' OR '.join(f'coalesce({beyond(r, f"c{i}")}, false)' for i, r in enumerate(rules))}) AS kept
FROM b LEFT JOIN cut ON b.lang IS NOT DISTINCT FROM cut.lang
"""


@query(_rules_sql())
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return done.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP12 = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
size AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY r),
total AS (SELECT count(*) AS nn, sum(n)::bigint AS l FROM size),
m AS (SELECT r, doc_id, 25 + ((75 * n * nn) // l) AS m FROM size, total),
weight AS (SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::bigint AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
scored AS (SELECT item_id, m.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint AS score
           FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY item_id, r, m.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::int AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query(OP12)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_nra.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT part, (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * len(t) THEN 4 ELSE 0 END) + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
        + (CASE WHEN coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) THEN 16 ELSE 0 END) AS fails,
        coalesce(quality, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM d LEFT JOIN (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::int) AS quality, max((toxic IS NOT DISTINCT FROM 1)::int) AS toxic FROM labels GROUP BY doc_id) AS known
      ON d.doc_id = known.doc_id),
c AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY part, fails, good, toxic),
bit(letter, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT p.letter || q.letter || r.letter || s.letter || u.letter AS filter_order, [p.b, q.b, r.b, s.b, u.b] AS bits FROM bit p, bit q, bit r, bit s, bit u
           WHERE p.b | q.b | r.b | s.b | u.b = 31),
steps AS (SELECT filter_order, k AS step, bits[k] AS own, coalesce(list_sum(bits[1:k - 1]), 0)::bigint AS before FROM orders, range(1, 6) AS x(k)),
report AS (SELECT part, filter_order, step, own, sum(CASE WHEN fails & (before | own) = 0 THEN n ELSE 0 END)::bigint AS kept,
                  sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN n ELSE 0 END)::bigint AS removed,
                  sum(CASE WHEN fails & own <> 0 AND fails & before <> 0 THEN n ELSE 0 END)::bigint AS redundant,
                  sum(CASE WHEN fails = own THEN n ELSE 0 END)::bigint AS unique_fails,
                  sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN n * good ELSE 0 END)::bigint AS good_lost,
                  sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN n * toxic ELSE 0 END)::bigint AS toxic_lost
           FROM c, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::int AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::bigint AS shapley FROM report
"""


@query(OP13)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = filter_audit.failures(table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.with_flags(failed, table(spark, sf_dir, "labels")))


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
