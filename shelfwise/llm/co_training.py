"""Quality classifier by co-training on two views of a document.

The text view sees the text: which of ``WORDS`` hash classes its lower-case words fall in, and the
measurements of the quality ledger. The page view sees only metadata: source, language and length.
Each view has its own logistic regression. In each round every document is scored by both; the
distinct unlabelled texts that one view is surest of become pseudo-labels for the *other* view (a
text with thousands of copies is one example), and both are fitted again. At the end both views are
calibrated and combined by a logistic regression on labelled rows that neither was fitted on, and
all documents are scored.

Fitting uses at most ``most_labels`` labelled rows (those with the smallest hash of their id) and
``per_round`` pseudo-labels per class, view and round: the driver holds that many feature rows
and no more. Features, scores and the choice of pseudo-labels cover all documents.

Nulls: null texts are empty, null metadata is a value of its own, labels that are null or name no
document are ignored. Documents with repeated ids are scored one by one; a label is then used for
each of them, and of several labels of one id the smallest counts. With labels of one class or none
every score is the smoothed share of good labels (0.5 without labels). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import quality_rules
from shelfwise.llm.common import lowest, stored, words_col

SOURCES, LANGS, WORDS = 32, 8, 512
#: Feature rows that are widened to numbers at once.
BLOCK = 4_096


@dataclass(frozen=True)
class Plan:
    rounds: int = 3
    per_round: int = 200
    sure: float = 0.95
    most_labels: int = 50_000
    l2: float = 1.0


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(row, id, text, text_view array, words array, page_view array): ``text`` is the text's hash, ``words`` the
    sorted distinct classes of its words."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{source_col}`").alias("source"), F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.select(F.struct(F.monotonically_increasing_id().alias("row"), "id", "source", "lang",
                                F.length(F.coalesce("text", F.lit(""))).alias("size"),
                                F.xxhash64("text").alias("text"), F.array_distinct(F.transform(words_col(F.lower("text")), lambda w: F.pmod(F.xxhash64(w), F.lit(WORDS)).cast("int"))).alias("words")).alias("doc"), "text")
    m = quality_rules.ledger(rows, "doc", "text")
    one_hot = lambda c, n: [F.when(F.pmod(F.xxhash64(F.coalesce(c, F.lit("?"))), F.lit(n)) == i, 1.0).otherwise(0.0) for i in range(n)]
    text_view = [_share("n_symbols", "n_words"), _share("word_chars", "n_words") / 10, _share("n_upper", "word_chars"),
                 _share("n_exclamations", "n_words"), _share("n_dup_lines", "n_lines"), _share("n_stutter_words", "n_words"),
                 _share("n_repeat_words", "n_words"), F.log1p("n_words") / 10, (_share("word_chars", "n_words") / 10 - 0.5) ** 2]
    page_view = [*one_hot(F.col("doc.source"), SOURCES), *one_hot(F.col("doc.lang"), LANGS), F.log1p("doc.size") / 10]
    return m.select("doc.row", "doc.id", "doc.text", F.sort_array("doc.words").alias("words"), F.array(*(F.least(x.cast("double"), F.lit(3.0)) for x in text_view)).alias("text_view"),
                    F.array(*(x.cast("double") for x in page_view)).alias("page_view"))


@dataclass(frozen=True)
class Examples:
    """Feature rows on the driver: measurements as numbers, word classes as one byte each. They are widened
    to a matrix with an intercept a block of rows at a time."""
    numbers: np.ndarray
    words: np.ndarray

    @staticmethod
    def of(view: str, rows: pa.Table) -> Examples:
        """Of collected rows; only the text view has word classes."""
        numbers = rows[view].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        if view != "text_view":
            return Examples(numbers, np.zeros((rows.num_rows, 0), np.uint8))
        lists, words = rows["words"].combine_chunks(), np.zeros((rows.num_rows, WORDS), np.uint8)
        words[np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = 1
        return Examples(numbers, words)

    @staticmethod
    def all(parts: list[Examples]) -> Examples:
        return Examples(np.vstack([e.numbers for e in parts]), np.vstack([e.words for e in parts]))

    def where(self, chosen: np.ndarray) -> Examples:
        return Examples(self.numbers[chosen], self.words[chosen])

    def blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        for i in range(0, len(self.numbers), BLOCK):
            at = slice(i, i + BLOCK)
            numbers, words = self.numbers[at], self.words[at]
            yield at, np.hstack([np.ones((len(numbers), 1)), numbers, words])

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.concatenate([x @ w for _, x in self.blocks()])


def fit_logistic(x: np.ndarray | Examples, y: np.ndarray, l2: float) -> np.ndarray:
    """Newton steps for an L2-penalised logistic regression; the first weight is the free intercept."""
    if not isinstance(x, Examples):
        x = Examples(x, np.zeros((len(x), 0), np.uint8))
    w = np.zeros(1 + x.numbers.shape[1] + x.words.shape[1])
    penalty = np.full(len(w), l2)
    penalty[0] = 1e-6
    for _ in range(30):
        h, slope = np.diag(penalty), -penalty * w
        for at, b in x.blocks():
            p = 1 / (1 + np.exp(-np.clip(b @ w, -30, 30)))
            h += (b * (p * (1 - p))[:, None]).T @ b
            slope += b.T @ (y[at] - p)
        step = np.linalg.solve(h, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _logit(view: str, w: np.ndarray) -> Column:
    """A view's linear score as a column over its feature array, and over the text's word classes."""
    n = len(w) - 1 - (WORDS if view == "text_view" else 0)
    terms = F.zip_with(F.col(view), F.array(*(F.lit(float(v)) for v in w[1:n + 1])), lambda a, b: a * b)
    score = F.lit(float(w[0])) + F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)
    if view == "text_view":
        by_class = F.array(*(F.lit(float(v)) for v in w[n + 1:]))
        score = score + F.aggregate("words", F.lit(0.0), lambda s, k: s + F.element_at(by_class, k + 1))
    return score


def _probability(logit: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))))


def train_and_score(docs: DataFrame, labels: DataFrame, plan: Plan = Plan(), label_col: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """(id, p_text, p_page, quality_score, kept) of every document."""
    rows = stored(features(docs, id_col), "features")
    given = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
             .dropna().groupBy("id").agg(F.min("y").alias("y")))
    marked = stored(rows.join(given, "id", "left").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(4))), "marked")
    labelled = marked.where("y is not null")
    known = lowest(labelled, F.xxhash64("id"), plan.most_labels).orderBy(F.xxhash64("id"), "row").limit(plan.most_labels) \
        .select("y", "part", "words", "text_view", "page_view").toArrow()  # bounded by the plan
    y = known["y"].to_numpy().astype(float)
    views = ("text_view", "page_view")
    if len(set(y)) < 2:
        p = (y.sum() + 1) / (len(y) + 2)
        return rows.select(F.col("id").alias(id_col), *(F.lit(float(p)).alias(c) for c in ("p_text", "p_page", "quality_score")), F.lit(bool(p >= 0.5)).alias("kept"))
    x, held = {v: Examples.of(v, known) for v in views}, known["part"].to_numpy() == 0
    del known
    if not 0 < y[held].mean() < 1 if held.any() else True:  # too few rows to keep some back
        held = np.zeros(len(y), bool)
    own = {v: [(x[v].where(~held), y[~held])] for v in views}
    fit = lambda v: fit_logistic(Examples.all([a for a, _ in own[v]]), np.concatenate([b for _, b in own[v]]), plan.l2)
    weights = {v: fit(v) for v in views}
    taken: set[int] = set()
    for _ in range(plan.rounds):
        for teacher, pupil in (views, views[::-1]):
            p = _probability(_logit(teacher, weights[teacher]))
            for good in (True, False):
                sure = marked.where("y is null").withColumn("p", p).where(F.col("p") >= plan.sure if good else F.col("p") <= 1 - plan.sure)
                # one row a distinct text; the texts' features are fetched for the picked ones only
                one = sure.groupBy("text").agg(F.max("p").alias("p") if good else F.min("p").alias("p"), F.min("row").alias("row"))
                picked = one.orderBy(F.desc("p") if good else F.asc("p"), F.xxhash64("row")).limit(plan.per_round + len(taken)).select("row", "text")
                new = [r for r in picked.collect() if r["text"] not in taken][:plan.per_round]
                taken.update(r["text"] for r in new)
                if new:
                    found = marked.where(F.col("row").isin([r["row"] for r in new])).select(pupil, "words").toArrow()
                    own[pupil].append((Examples.of(pupil, found), np.full(found.num_rows, float(good))))
        weights = {v: fit(v) for v in views}
    back = held if held.any() else np.ones(len(y), bool)
    logits = np.column_stack([x[v].where(back).scores(weights[v]) for v in views])
    each = [fit_logistic(logits[:, [k]], y[back], plan.l2) for k in range(2)]  # calibration of each view
    both = fit_logistic(np.column_stack([each[k][0] + each[k][1] * logits[:, k] for k in range(2)]), y[back], plan.l2)
    calibrated = [F.lit(float(each[k][0])) + float(each[k][1]) * _logit(v, weights[v]) for k, v in enumerate(views)]
    return (rows.select("id", calibrated[0].alias("t"), calibrated[1].alias("g"))
            .select(F.col("id").alias(id_col), _probability(F.col("t")).alias("p_text"), _probability(F.col("g")).alias("p_page"),
                    _probability(F.lit(float(both[0])) + float(both[1]) * F.col("t") + float(both[2]) * F.col("g")).alias("quality_score"))
            .withColumn("kept", F.col("quality_score") >= 0.5))
