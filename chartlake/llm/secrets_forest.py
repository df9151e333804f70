"""Secret scan with a random forest that removes false positives
(DataFrame, SQL and JVM machine-learning functions only).

Candidates are, over whole texts, runs of 16 or more characters of
[A-Za-z0-9+/_-] and, whatever their length and characters, the whole values of
key-word contexts: what stands in quotes behind a name that holds a key word, or
what is assigned to it (up to a blank where it has no quotes; up to a quote as well if it
holds one).  A value that is just such a run is one candidate.  Each becomes a row of features: length; character transitions
(letter to digit and back, lower to upper), class shares and distinct
characters; dictionary coverage (the share of its letters that are runs the
corpus uses as words in ``min_docs`` documents or more); path (what the path
column says); neighbouring words (key words, assignment, quotes, mail and URL
signs just before and after, and how many words of prose stand around).  A random forest trained from labelled findings
scores them; findings below the threshold are false positives.

Labels are a table of reviewed findings (id, value, label) or, for corpora that
have none, a function of the candidates such as ``weak_labels``.  A forest that
sees what such a rule reads learns the rule back, so with a rule the features it reads
are left out of the fit (``INDEPENDENT`` for ``weak_labels``): the forest then tells from the value,
the path and the other neighbours, which the rule does not look at.

The fit takes at most ``MAX_LABELLED`` labelled findings, those with the
smallest hash of each class (half of them each, or all of a smaller class),
weighted by the full counts of the classes; candidates, dictionary counts and scores cover all rows.

Defined results: null and empty texts have no candidates; a null path is empty;
null ids and repeated rows are kept as they are, one finding each; labelled
findings of one class only (or none) give every candidate that class's label as
score (0.5 for none); a finding reviewed more than once has its largest label;
the three noncharacters U+FDD0 to U+FDD2 are read as U+FFFD; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.llm.common import LOWER, UPPER, col, text_or_empty
from chartlake.session import cut_lineage

CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}+"
KEY_WORDS = "token|secret|passw|api.?key|auth|credential|bearer|private"
_NAME = r"(?<![\w.\-])(?=[\w.\-]*?(?i:" + KEY_WORDS + r"))[\w.\-]++(?: (?i:key|token|value|phrase|word|id)[\w.\-]*+)?+(?:\\*+[\"'`])?+[\])]?+"
_ASSIGN = r"\s*+(?::[ \t]*+[A-Za-z_][\w.]*+[ \t]*+=(?!=)|=>|:=|={1,3}+|:{1,2}+)\s*+"
#: A key-word context.  Groups: 1 the opening quotes, 2 the quoted value, 3 what follows it, 4 the value without
#: quotes, 5 what follows it.  A quoted value is only looked at, so that contexts inside it are met as well.
CONTEXT = (_NAME + "(?:(?:" + _ASSIGN + r"|[\s(\[{,]++)(\\*+(?:\"\"\"|'''|[\"'`]))(?=((?:(?!\1)(?:\\[\s\S]|[^\\]))++)(\1[\s\S]{0,39}))"
           "|" + _ASSIGN + r"(?:\\*+[\"'`])?+((?!\\*[\"'`])(?:[^\s&,;]|[&,;](?![\w.\-]++[=:]))++)(?=([\s\S]{0,40})))")
PLACEHOLDERS = "example|sample|dummy|fake|placeholder|test|xxxx"
MAX_LABELLED = 20_000
LEFT, RIGHT = 80, 40

FEATURES = ("length", "digits", "uppers", "transitions", "distinct_chars", "hex_only", "digits_only", "dictionary", "path_test", "path_depth",
            "key_word_near", "assigned", "quoted", "mail_or_url", "placeholder_near", "letters_before", "same_run", "words_before", "words_after")
#: The features that read nothing of what ``weak_labels`` reads: no name, assignment or quote beside the value.
INDEPENDENT = tuple(f for f in FEATURES if f not in ("key_word_near", "assigned", "quoted", "letters_before"))
#: Noncharacters that mark the matches in a text: a match begins, its groups follow, it ends.
BEGIN, NEXT, END = "\uFDD0", "\uFDD1", "\uFDD2"


def _matches(text: Column, pattern: str, *groups: int) -> Column:
    """What ``pattern`` cuts a text into, in one pass: an array whose first element is the
    text before the first match and whose others hold END between a match's groups (NEXT between them) and the text after it."""
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(BEGIN + NEXT.join(f"${g}" for g in groups) + END))
    return F.split(marked, BEGIN, -1)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """(id, path, ordinal, value, before, after): one row per candidate; ordinal
    counts the candidates of a text, runs first.  Each pattern passes once over a text and
    marks its matches; the pieces between the marks are their surroundings."""
    path = F.coalesce(col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    text = text_or_empty(text_col)
    clean = F.when(text.rlike(f"[{BEGIN}-{END}]"), F.translate(text, BEGIN + NEXT + END, "\uFFFD" * 3)).otherwise(text)
    rest = lambda x: F.get(F.split(x, END, 2), F.lit(1))
    group = lambda x, k: F.get(F.split(F.get(F.split(x, END, 2), F.lit(0)), NEXT, -1), F.lit(k))
    # the text before the first match holds no END, so it is kept apart
    parts = lambda m, g: F.transform(F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0))), lambda x: F.struct(
        *[group(x, k).alias(n) for k, n in enumerate(g)], rest(x).alias("rest")))
    cut = docs.select(col(id_col).alias("id"), path.alias("path"), clean.alias("t")) \
        .select("id", "path", _matches(F.col("t"), CANDIDATE, 0).alias("v"), _matches(F.col("t"), CONTEXT, 0, 2, 3, 4, 5).alias("n")) \
        .where((F.size("v") > 1) | (F.size("n") > 1)) \
        .select("id", "path", F.get("v", F.lit(0)).alias("v0"), parts(F.col("v"), ["value"]).alias("v"),
                F.get("n", F.lit(0)).alias("n0"), parts(F.col("n"), ["all", "q", "q_after", "u", "u_after"]).alias("n"))
    ahead = lambda items, first, i: F.when(i == 0, F.col(first)).otherwise(F.get(items, i - 1)["rest"])
    runs = F.transform(F.col("v"), lambda v, i: F.struct(
        v["value"].alias("value"), F.substring(ahead(F.col("v"), "v0", i), -LEFT, LEFT).alias("before"), F.substring(v["rest"], 1, RIGHT).alias("after")))
    values = F.transform(F.col("n"), lambda n, i: F.struct(
        F.concat(n["q"], n["u"]).alias("value"),
        F.substring(F.concat(ahead(F.col("n"), "n0", i), F.substring(n["all"], F.lit(1), F.length(n["all"]) - F.length(n["u"]))), -LEFT, LEFT).alias("before"),
        F.substring(F.concat(n["q_after"], n["u_after"]), 1, RIGHT).alias("after")))
    # where quotes end a value without quotes is open (it's, or "?token=x"): both readings are candidates
    head = lambda x: F.regexp_extract(x["value"], "^([^\"'`]+?)\\\\*[\"'`]", 1)
    heads = F.transform(F.filter(F.arrays_zip(F.col("n.u").alias("u"), values.alias("x")), lambda z: z["u"].rlike("[\"'`]")), lambda z: F.struct(
        head(z["x"]).alias("value"), z["x"]["before"].alias("before"),
        F.substring(F.concat(F.substring(z["u"], F.length(head(z["x"])) + 1, F.lit(RIGHT)), z["x"]["after"]), 1, RIGHT).alias("after")))
    # a value that is a whole run is among the runs
    other = F.filter(F.concat(values, heads), lambda x: ~x["value"].rlike("^" + CANDIDATE + r"\z"))
    return cut.select("id", "path", F.posexplode(F.concat(runs, other)).alias("ordinal", "c")).select("id", "path", "ordinal", "c.*")


def letter_runs(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("[a-z]{3,}+"), F.lit(0))


def dictionary(docs: DataFrame, text_col: str = "text", min_docs: int = 20) -> DataFrame:
    """(word): letter runs found in at least ``min_docs`` rows, counted over all whole texts."""
    return docs.select(F.explode(F.array_distinct(letter_runs(text_or_empty(text_col)))).alias("word")) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("word")


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with the columns ``FEATURES``."""
    runs = found.select("value").distinct().select("value", F.explode(letter_runs(F.col("value"))).alias("word"))
    known = runs.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    v, before, after = F.col("value"), F.lower("before"), F.lower("after")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return found.join(known, "value", "left").withColumns({
        "length": F.least(F.length(v), F.lit(512)).cast("double"),
        "digits": _share(v, "[0-9]"),
        "uppers": _share(v, "[A-Z]"),
        "transitions": _share(v, "(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])"),
        "distinct_chars": F.size(F.array_distinct(F.split(v, ""))) / F.length(v),
        "hex_only": flag(v.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "digits_only": flag(v.rlike("^[0-9]+$")),
        "dictionary": F.coalesce(F.col("covered"), F.lit(0)) / F.length(v),
        "path_test": flag(F.lower("path").rlike("test|example|sample|fixture|doc")),
        "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "key_word_near": flag(before.rlike(f"({KEY_WORDS})[^a-z]{{0,8}}$")),
        "assigned": flag(before.rlike("[=:]\\s*[\"']?$")),
        "quoted": flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        "mail_or_url": flag(before.rlike("(@|://)\\S*$") | after.rlike("^\\S*@")),
        "placeholder_near": flag(before.rlike(PLACEHOLDERS) | after.rlike(PLACEHOLDERS)),
        "letters_before": F.length(F.regexp_extract(before, "([a-z]+)[^a-z]*$", 1)).cast("double"),
        "same_run": flag(v.rlike("(.)\\1{5}")),
        # words of prose; a name that is assigned to, and what stands in the same word as the value, is none
        "words_before": F.regexp_count(before, F.lit(r"(?<!\S)[a-z]{2,}[.,;]?\s++(?![=:\"'])")).cast("double"),
        "words_after": F.regexp_count(after, F.lit(r"(?<=\s)[a-z]{2,}[.,;]?(?=\s)")).cast("double"),
    }).drop("covered")


def fit(labelled: DataFrame, trees: int = 20, depth: int = 5, seed: int = 7, max_labelled: int = MAX_LABELLED,
        features: tuple[str, ...] = FEATURES):
    """labelled: feature columns and label (0 or 1).  A model fitted on ``features``, or a
    number where the labels have one class only."""
    order = F.xxhash64("value", F.col("id").cast("string"), "ordinal")
    labelled = labelled.where("label is not null").withColumn("label", F.col("label").cast("double"))
    seen = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(seen) < 2:
        return next(iter(seen), 0.5)
    # what one class leaves of its half goes to the other; weights give the classes their full counts back
    total = sum(seen.values())
    taken = {k: min(n, max(1, max_labelled // 2, max_labelled - (total - n))) for k, n in seen.items()}
    sample = cut_lineage(reduce(DataFrame.unionByName, (
        labelled.where(F.col("label") == k).orderBy(order, "value").limit(taken[k]).select(*features, "label", F.lit(seen[k] / taken[k]).alias("weight"))
        for k in sorted(seen))))
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        RandomForestClassifier(weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=2, featureSubsetStrategy="sqrt"),
    ]).fit(sample)


def score(featured: DataFrame, model) -> DataFrame:
    """Candidates with a score between 0 and 1."""
    if isinstance(model, float):
        return featured.withColumn("score", F.lit(model))
    return model.transform(featured).withColumn("score", vector_to_array("probability")[1]) \
        .drop("features", "rawPrediction", "probability", "prediction")


def weak_labels(featured: DataFrame) -> Column:
    """Labels for corpora without reviewed findings: 1 for a value that a quoted
    assignment to a key word holds, 0 for everything else."""
    return (F.col("before").rlike("(?i)\\b(token|secret|password|api_?key)\\s*=\\s*[\"']$") & F.col("after").rlike("^[\"']")).cast("int")


def reviewed(featured: DataFrame, findings: DataFrame) -> DataFrame:
    """Candidates with the labels of reviewed findings (id, value, label): null where nobody looked."""
    known = findings.groupBy(col("id").alias("f_id"), col("value").alias("f_value")).agg(F.max("label").cast("int").alias("label"))
    return featured.join(known, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("value") == F.col("f_value")), "left").drop("f_id", "f_value")


def scan(docs: DataFrame, labels, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source",
         held_out: Column | None = None, min_docs: int = 20, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """All candidates of ``docs`` with features, label and score.  labels: a table of
    reviewed findings (id, value, label), or a
    function of the featured candidates that gives the label column (null where
    a finding has none); rows under ``held_out`` (a column over ``id``) never
    take part in the fit, which sees ``features`` only."""
    found = cut_lineage(candidates(docs, id_col, text_col, path_col))  # used twice, read from the texts once
    featured = cut_lineage(with_features(found, dictionary(docs, text_col, min_docs)))
    labelled = reviewed(featured, labels) if isinstance(labels, DataFrame) else featured.withColumn("label", labels(featured))
    model = fit(labelled.where(~held_out) if held_out is not None else labelled, features=features)
    return score(labelled, model)
