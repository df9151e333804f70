"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Every rule compares two counts of a text with a cutoff from a declared grid,
loosest first ("100 * symbols > cutoff * words").  Labelled good documents are
the holdout: for each stratum and rule the grid is walked from the loosest cutoff
on, and a cutoff is certified if the exact binomial probability of seeing no
more false rejections than were seen, were the true rate ``risk`` / number of
rules, is at most ``miss`` / (strata * rules).  The walk ends at the first cutoff
that is not certified (fixed-sequence testing), so the correction counts strata
and rules, not cutoffs, and all choices hold together with probability 1 - miss:
a stratum's rules reject at most ``risk`` of its good documents that pass the
base rules.  A rule without a certified cutoff rejects nothing there.

Base rules reject whatever the labels say: fewer than ``MIN_WORDS`` words, or over
``MAX_REPEATED`` percent of the words inside a 3-word window found twice or more
in the text.  Such windows are found exactly: hashes only preselect windows,
and those are compared as strings.

Words are maximal runs of [^\\x20\\x09-\\x0D].

Defined results: null and empty texts have no words and fail the base rules;
null strata are a stratum of their own; rows that share an id are separate
documents, each with the id's label; an id is good if all its labels are 1,
null ids and null labels are no labels; equal values do not exceed a cutoff;
without labels, or with too few, only the base rules reject; an empty table
gives no rows.  Texts are measured one at a time, in memory proportional to
the words of one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.llm.common import BLANKS, col, fresh, text_or_empty
from chartlake.session import cut_lineage

MIN_WORDS = 50
MAX_REPEATED = 50
#: Strata whose cutoffs are broadcast; beyond it the planner chooses the join.
BROADCAST_STRATA = 10_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks")


@dataclass(frozen=True)
class Rule:
    """Rejects if 100 * part is above (or, if not ``above``, below) cutoff * whole."""

    name: str
    part: str
    whole: str
    grid: tuple[int, ...]
    above: bool = True

    def rejects(self, cutoff: Column) -> Column:
        part, bound = F.lit(100) * col(self.part), cutoff * col(self.whole)
        return part > bound if self.above else part < bound


RULES = (
    Rule("symbols", "n_symbols", "n_words", (200, 100, 50, 30, 20, 10, 5)),
    Rule("repeats", "n_repeat_words", "n_words", (45, 40, 35, 30, 25, 20, 15, 10)),
    Rule("dup_lines", "n_dup_lines", "n_lines", (70, 50, 40, 30, 20, 10)),
    Rule("upper", "n_upper", "word_chars", (90, 70, 50, 40, 30, 20, 10)),
    Rule("marks", "n_marks", "n_words", (100, 70, 50, 30, 20, 10, 5)),
    Rule("long_words", "word_chars", "n_words", (3000, 2000, 1500, 1200, 1000, 900)),
    Rule("short_words", "word_chars", "n_words", (150, 200, 250, 300, 350), above=False),
)


def measure(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns of ``COUNTS`` (long) appended, and their names.

    Arrays that a later step names twice are columns of their own, so that the
    optimiser does not compute them again for every element."""
    names = dict(zip(COUNTS, fresh(docs, *COUNTS), strict=True))
    text, words, lines, grams, near, at, runs = (fresh(docs, *names.values(), x)[-1] for x in ("q_text", "q_words", "q_lines", "q_grams", "q_near", "q_at", "q_runs"))
    low = F.lit((1 << 31) - 1).cast("long")
    none = F.array().cast("array<long>")

    df = docs.withColumn(text, text_or_empty(text_col))
    trimmed = F.btrim(col(text), F.lit(BLANKS))
    df = df.withColumn(words, F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+")))
    df = df.withColumn(lines, F.filter(F.split(col(text), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    # one number per 3-word window: 33 bits of its hash above its place
    n = F.size(col(words))
    place = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    gram = lambda i: F.xxhash64(F.get(col(words), i), F.get(col(words), i + 1), F.get(col(words), i + 2))
    df = df.withColumn(grams, F.sort_array(F.transform(place, lambda i: gram(i).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))))

    def beside(array: str, same):
        """Elements of a sorted array that agree with a neighbour."""
        return F.filter(col(array), lambda x, i: F.coalesce(same(F.get(col(array), i - 1), x), F.lit(False)) | F.coalesce(same(F.get(col(array), i + 1), x), F.lit(False)))

    high = lambda x: F.shiftright(x, 31)
    df = df.withColumn(near, beside(grams, lambda a, b: high(a) == high(b)))
    window = lambda p: F.concat_ws(" ", F.get(col(words), p), F.get(col(words), p + 1), F.get(col(words), p + 2))
    df = df.withColumn(at, F.sort_array(F.transform(col(near), lambda x: F.struct(window(x.bitwiseAND(low).cast("int")).alias("w"), x.bitwiseAND(low).alias("p")))))
    df = df.withColumn(runs, F.sort_array(F.transform(beside(at, lambda a, b: a["w"] == b["w"]), lambda x: x["p"])))
    covered = F.aggregate(F.coalesce(col(runs), none), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
                          lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n"), p.alias("last")), lambda acc: acc["n"])
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join(col(words), "")),
        "n_symbols": F.regexp_count(col(text), F.lit("[#*$%&|<>]")),
        "n_lines": F.size(col(lines)),
        "n_dup_lines": F.size(col(lines)) - F.size(F.array_distinct(col(lines))),
        "n_repeat_words": covered,
        "n_upper": F.regexp_count(col(text), F.lit("[A-Z]")),
        "n_marks": F.regexp_count(col(text), F.lit("[!?]")),
    }
    return df.select(*[col(c) for c in docs.columns], *[counts[c].cast("long").alias(names[c]) for c in COUNTS]), names


def base_failed(min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """Exact P(X <= k) for X of n draws at ``rate``, for k below n * rate; 1 from there on.

    Horner's scheme from the smallest term up: the sum of all terms relative to
    the largest, and the logarithm of the largest, so nothing under- or overflows."""
    start = F.struct(F.lit(1.0).alias("sum"), (n * F.log1p(F.lit(-rate))).alias("log"))

    def step(acc: Column, i: Column) -> Column:
        odds = (n - i + 1) / i * F.lit(rate / (1 - rate))
        return F.struct((acc["sum"] / odds + 1).alias("sum"), (acc["log"] + F.log(odds)).alias("log"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    exact = F.aggregate(terms, start, step, lambda acc: acc["sum"] * F.exp(acc["log"]))
    return F.when(k < n * F.lit(rate), exact).otherwise(F.lit(1.0))


def certify(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "stratum", label_col: str = "quality",
            rules: tuple[Rule, ...] = RULES, risk: float = 0.05, miss: float = 0.05) -> DataFrame:
    """(stratum, n_good, cutoffs): the certified cutoff of each rule by its place, null if there is none.

    measured: id, stratum and the counts, a row per document."""
    (good_id,) = fresh(measured, "good_id")
    known = cut_lineage(labels.select(col(id_col).alias(good_id), col(label_col).alias("label")).where(col(good_id).isNotNull() & F.col("label").isNotNull())
                        .groupBy(good_id).agg(F.min((F.col("label") == 1).cast("int")).alias("good")).where("good = 1").select(good_id))
    good = measured.where(~base_failed()).join(known, col(id_col) == col(good_id), "left_semi")
    hits = F.array(*[F.array(*[F.count_if(rule.rejects(F.lit(c))) for c in rule.grid]) for rule in rules])
    counted = cut_lineage(good.groupBy(col(stratum_col).alias("stratum")).agg(F.count(F.lit(1)).alias("n_good"), hits.alias("rejected")))
    level = miss / (max(1, counted.count()) * len(rules))
    rate = risk / len(rules)

    def chosen(place: int, rule: Rule) -> Column:
        certified = F.transform(F.get("rejected", F.lit(place)), lambda k: binomial_tail(k, F.col("n_good"), rate) <= F.lit(level))
        passed = F.coalesce(F.nullif(F.array_position(certified, False), F.lit(0).cast("long")), F.lit(len(rule.grid) + 1)) - 1
        return F.get(F.array(*[F.lit(c) for c in rule.grid]), (passed - 1).cast("int"))

    return counted.select("stratum", "n_good", F.array(*[chosen(i, rule) for i, rule in enumerate(rules)]).alias("cutoffs"))


def judge(measured: DataFrame, cutoffs: DataFrame, stratum_col: str = "stratum", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measured`` with base_failed, failed_rules (names) and kept appended."""
    of, chosen = fresh(measured, "of_stratum", "cutoffs")
    known = cut_lineage(cutoffs.select(F.col("stratum").alias(of), F.col("cutoffs").alias(chosen)))
    if known.count() <= BROADCAST_STRATA:
        known = F.broadcast(known)
    failed = F.array_compact(F.array(*[F.when(rule.rejects(F.get(col(chosen), F.lit(i))), F.lit(rule.name)) for i, rule in enumerate(rules)]))
    return measured.join(known, col(stratum_col).eqNullSafe(col(of)), "left") \
        .select(*[col(c) for c in measured.columns], base_failed().alias("base_failed"), failed.alias("failed_rules")) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality",
                rules: tuple[Rule, ...] = RULES, risk: float = 0.05, miss: float = 0.05) -> DataFrame:
    """(id, stratum, the counts, base_failed, failed_rules, kept) of every row of ``docs``."""
    plain = docs.select(col(id_col).alias("id"), col(stratum_col).alias("stratum"), col(text_col).alias("text"))
    measured, _ = measure(plain, "text")
    measured = cut_lineage(measured.drop("text"))  # the texts are read once
    own = labels.select(col(id_col).alias("id"), col(label_col).alias("quality"))
    return judge(measured, certify(measured, own, "id", "stratum", "quality", rules, risk, miss), "stratum", rules)
