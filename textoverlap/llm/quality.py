"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation estimates their accuracies, and the
posterior probability of good quality decides.

Every rule reads one statistic of the whole text and votes good (1), bad (-1) or abstains (0). Texts are counted by
their votes (at most 3 ** rules rows, a few hundred in practice), and the model is fitted on that table by
DataFrame aggregations of one row a round: the share of good texts, and for each rule how often its vote is right
on good and on bad texts. Abstaining tells nothing. Rules are taken to be better than chance (a prior of
``PRIOR`` right and one wrong vote per ``PRIOR_SHARE`` of the texts), so that classes cannot swap. A text is kept if the
posterior is at least one half and the base rules (``base_failed``) pass.

Built-in functions only; the statistics need no shuffle.

Defined cases: null and blank texts have no words, every rule abstains and the base rules fail; repeated rows are
judged alike; empty tables give empty results; all columns of the input are kept as they are in ``row``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textoverlap.llm.common import SPACE, materialize, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
ROUNDS = 12
PRIOR = 9.0          # right votes for one wrong
PRIOR_SHARE = 0.02   # weight of the prior as a share of the texts

# Common words of the languages that are told apart from word lists (fixed values)
STOP_WORDS = ("the of and to in that is was with for der die und das ist von mit den nicht ein de la le et les des est "
              "que un une el los las del por con para una y en").split()

# rule: (statistic, vote good when, vote bad when); a test is (operator, value) or None for never. Rules against rare
# defects abstain where there is none, as passing them says little.
RULES = {
    "symbols": ("symbol_ratio", ("<=", 0.02), (">", 0.1)),
    "letters": ("letter_ratio", (">=", 0.92), ("<", 0.87)),
    "stop_words": ("stop_kinds", (">=", 3.0), ("<", 1.0)),
    "duplicate_lines": ("dup_line_ratio", None, (">", 0.3)),
    "repetition": ("repeat_ratio", None, (">", 0.3)),
    "word_length": ("mean_word", None, ("outside", (2.5, 12.0))),
    "upper_case": ("upper_ratio", None, (">", 0.3)),
    "digits": ("digit_ratio", None, (">", 0.2)),
    "shouting": ("shout_ratio", None, (">", 0.3)),
    "variety": ("variety", None, ("<", 0.1)),
}


def with_statistics(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id`` and the statistics of the whole text: ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words`` and those that the rules read (null where there are no words)."""
    text = F.coalesce(docs["text"], F.lit(""))
    base = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("doc_id"),
                       text.alias("text"), words(docs["text"]).alias("w"),
                       F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"))
    n = F.size("w")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(
        *[F.get("w", i + j) for j in range(WINDOW)]))).otherwise(F.array().cast("array<long>"))
    counted = lambda keep: F.length(F.regexp_replace("text", f"[^{keep}]+", ""))
    base = base.select(
        "row", "doc_id", n.alias("n"), windows.alias("h"),
        F.length(F.regexp_replace("text", SPACE, "")).alias("word_chars"), counted("#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), F.size("lines").alias("n_lines"),
        counted("\\p{Lu}").alias("upper"), counted("\\p{L}").alias("letters"), counted("0-9").alias("digits"), counted("!").alias("shouts"),
        F.size(F.array_intersect("w", F.array(*[F.lit(y) for x in STOP_WORDS for y in (x, x.capitalize())]))).alias("stop_kinds"),
        F.size(F.array_distinct("w")).alias("kinds"))
    # windows that occur again stand side by side when sorted; each covers its words
    pairs = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    again = F.when(F.size(F.array_distinct("h")) < F.size("h"), pairs)
    base = base.withColumn("again", again).drop("h")
    same = lambda i, j: F.get("again", i)["h"] == F.get("again", j)["h"]
    twice = F.filter("again", lambda x, k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(*[x["i"] + j for j in range(WINDOW)])))))
    repeat = F.when(F.col("again").isNull(), 0).otherwise(covered)
    base = base.withColumn("n_repeat_words", repeat).drop("again")
    # one row from one row, so that filters on the statistics stay above: pushed down, they would compute the arrays anew
    # for every element
    base = base.select("row", "doc_id", F.inline(F.array(F.struct(*[c for c in base.columns if c not in ("row", "doc_id")]))))
    per_word = lambda c: F.when(F.col("n") > 0, F.col(c) / F.col("n"))
    per_char = lambda c: F.when(F.col("word_chars") > 0, F.col(c) / F.col("word_chars"))
    some = lambda c: F.when(F.col("n") > 0, c)
    return base.select(
        "row", "doc_id", F.col("n").cast("long").alias("n_words"),
        *[F.col(c).cast("long").alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        per_word("n_symbols").alias("symbol_ratio"), per_word("n_repeat_words").alias("repeat_ratio"), per_word("word_chars").alias("mean_word"),
        some(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_ratio"),
        F.when(F.col("letters") > 0, F.col("upper") / F.col("letters")).alias("upper_ratio"), per_char("letters").alias("letter_ratio"),
        per_char("digits").alias("digit_ratio"), per_word("shouts").alias("shout_ratio"), some(F.col("stop_kinds").cast("double")).alias("stop_kinds"),
        per_word("kinds").alias("variety"))


def _holds(c: Column, test: tuple | None) -> Column:
    if test is None:
        return F.lit(False)
    op, v = test
    if op == "outside":
        return (c < v[0]) | (c > v[1])
    return {"<=": c.__le__, ">": c.__gt__, ">=": c.__ge__, "<": c.__lt__}[op](v)


def votes(stats: DataFrame) -> DataFrame:
    """Adds ``votes``, an array of -1, 0 and 1 by rule, and ``base_failed``."""
    vote = [F.when(_holds(F.col(s), good), 1).when(_holds(F.col(s), bad), -1).otherwise(0).cast("tinyint")
            for s, good, bad in RULES.values()]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return stats.withColumn("votes", F.array(*vote)).withColumn("base_failed", failed)


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and by rule the chance that a vote is right on good and on bad texts."""

    good: float = 0.8
    right_good: tuple[float, ...] = (0.9,) * len(RULES)
    right_bad: tuple[float, ...] = (0.9,) * len(RULES)

    def posterior(self, votes: str = "votes") -> str:
        """SQL expression of the posterior of an array of votes."""
        odds = [f"ln({self.good!r}D / {1 - self.good!r}D)"]
        for j, (g, b) in enumerate(zip(self.right_good, self.right_bad)):
            odds.append(f"CASE get({votes}, {j}) WHEN 1 THEN ln({g!r}D / {1 - b!r}D) WHEN -1 THEN ln({1 - g!r}D / {b!r}D) ELSE 0D END")
        return f"(1D / (1D + exp(-({' + '.join(odds)}))))"


def fit(voted: DataFrame, rounds: int = ROUNDS) -> LabelModel:
    """Label model of the texts of ``voted`` that pass the base rules (those that fail go whatever the votes)."""
    table = voted.where(~F.col("base_failed")).groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    table = materialize(table.coalesce(1), "votes")  # at most 3 ** rules rows
    model = LabelModel()
    sums = ["sum(n) AS n", "sum(n * q) AS good"]
    for j in range(len(RULES)):
        v = f"get(votes, {j})"
        sums += [f"sum(n * q) FILTER (WHERE {v} = 1) AS gg{j}", f"sum(n * q) FILTER (WHERE {v} <> 0) AS g{j}",
                 f"sum(n * (1D - q)) FILTER (WHERE {v} = -1) AS bb{j}", f"sum(n * (1D - q)) FILTER (WHERE {v} <> 0) AS b{j}"]
    for _ in range(rounds):
        r = table.selectExpr("votes", "n", f"{model.posterior()} AS q").selectExpr(*sums).first()
        if not r["n"]:
            return model
        p = PRIOR_SHARE * r["n"]
        rate = lambda right, voted_: ((right or 0.0) + p * PRIOR / (PRIOR + 1)) / ((voted_ or 0.0) + p)
        bound = lambda x: min(max(x, 0.55), 0.995)
        model = LabelModel(min(max(r["good"] / r["n"], 0.5), 0.99), tuple(bound(rate(r[f"gg{j}"], r[f"g{j}"])) for j in range(len(RULES))),
                           tuple(bound(rate(r[f"bb{j}"], r[f"b{j}"])) for j in range(len(RULES))))
    return model


def judge(voted: DataFrame, model: LabelModel) -> DataFrame:
    """Adds ``quality``, the posterior, and ``kept``."""
    return voted.withColumn("quality", F.expr(model.posterior())).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def quality(docs: DataFrame) -> DataFrame:
    """``doc_id``, base statistics, ``votes``, ``base_failed``, ``quality``, ``kept`` per row of ``docs``; one pass over the texts."""
    voted = votes(with_statistics(docs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                "votes", "base_failed")
    voted = materialize(voted, "quality")
    return judge(voted, fit(voted))


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are. The rows are written once with their votes, so statistics are
    computed once; the texts are never shuffled."""
    voted = materialize(votes(with_statistics(docs)).select("row", "votes", "base_failed"), "voted_rows")
    return judge(voted, fit(voted.select("votes", "base_failed"))).where("kept").select("row.*")
