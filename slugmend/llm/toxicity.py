"""Toxicity by maximum-scoring segments of token log-odds.

*Scores.* Every token (a word, or the first letters of one) has a log-odds of
being in toxic against clean labelled documents, smoothed by an informative
Dirichlet prior (its share of all labelled documents). Tokens whose z-score and
log-odds are high carry their log-odds as a positive score; all other words
score ``-drift``.

*Segments.* Ruzzo and Tompa's linear scan lists all maximal scoring segments
of a text: the toxic passages, wherever they are and however long the text.

*Calibration.* On clean text the best score of n words follows an extreme-value
law: passages of score S or more are expected ``K n exp(-lambda S)`` times.
lambda solves ``sum p(score) exp(lambda score) = 1`` over clean words, K comes
from the passages found in clean labelled documents. A document's evidence is
the sum over its passages of ``max(0, lambda S - log(K n))``, and a logistic
curve fitted on the labelled sample turns it into a score from 0 to 1.

*What is fitted on what.* Labels of rows whose ``crc32(doc_id) mod 5`` is 0 are
never read. The classifier is fitted on a bounded sample of the others: the
``max_labelled`` labels with the smallest hash of their id, a documented limit;
of its near copies (documents with the same smallest shingle hash) one counts;
its terms are bounded by ``max_terms``. Both are small enough to send to every
task. Every document's whole text is scored, in one map without a shuffle.

Edge cases: null and empty texts have no passage and get the score of no
evidence; a null ``doc_id`` is not held out; several labels of one document
count as the largest; without labels of both kinds every score is the share of
toxic labels (0 if there are none); an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slugmend.llm.common import map_arrow, slices, texts_of
from slugmend.sources.cuts import materialise

CACHE_WORDS = 400_000
_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class ToxicityRules:
    max_labelled: int = 20_000  #: labelled rows the classifier is fitted on
    max_terms: int = 20_000  #: tokens with a score of their own
    prefix: int = 4  #: letters of the token that stands for a word's beginning
    prior_share: float = 0.1  #: weight of the Dirichlet prior against the counts
    min_z: float = 4.0
    min_odds: float = 1.0
    drift: float = 0.1  #: what every other word costs a passage
    folds: int = 5  #: labels of remainder 0 are held out


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def tokens(word: str, prefix: int) -> tuple[str, ...]:
    """The word, and its beginning if it is longer; the two kinds never meet."""
    return (word, word[:prefix] + "*") if len(word) > prefix else (word,)


@dataclass(frozen=True)
class Model:
    terms: dict[str, float]
    prefix: int
    drift: float
    rate: float = 1.0  # lambda
    per_word: float = 1.0  # K
    slope: float = 0.0
    offset: float = -10.0


class Scorer(dict):
    """A task's scorer; the dict is the cache word -> positive score or 0."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        score = self[word] = max(self.model.terms.get(t, 0.0) for t in tokens(word, self.model.prefix))
        return score

    def passages(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Words of the text, and its maximal scoring segments (first word, end, score)."""
        scores = list(map(self.__getitem__, _WORD.findall(text.lower())))
        if not any(scores):
            return len(scores), []
        return len(scores), segments([(i, s) for i, s in enumerate(scores) if s], self.model.drift)

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        expected = math.log(max(self.model.per_word * n, 1e-9)) if n else 0.0
        return sum(max(0.0, self.model.rate * s - expected) for _, _, s in found)

    def score(self, evidence: float) -> float:
        x = self.model.offset + self.model.slope * math.log1p(evidence)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (Ruzzo and Tompa), in order: (first word, end, score).

    ``hits``: the positions with a positive score; the words between cost ``drift``
    each, so only hits are visited. Candidates carry the running total before and
    after them; each knows the nearest candidate before it with a smaller start.
    """
    out: list[list] = []  # first, end, total before, total after, index of the nearest candidate with a smaller start
    total, last = 0.0, -1
    for at, score in hits:
        total -= drift * (at - last - 1)
        last = at
        new = [at, at + 1, total, total + score, -1]
        total += score
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= new[2]:
                j = out[j][4]
            if j < 0 or out[j][3] >= new[3]:
                new[4] = j
                out.append(new)
                break
            new = [out[j][0], new[1], out[j][2], new[3], -1]  # they join into one
            del out[j:]
    return [(a, b, after - before) for a, b, before, after, _ in out]


def _labelled(docs: DataFrame, labels: DataFrame, rules: ToxicityRules) -> DataFrame:
    """``text``, ``toxic`` of the sample; its ids are at most ``max_labelled``, so they go to every task."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), rules.folds))
    sample = (
        usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.max_labelled)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")
    found = found.transform(map_arrow, _families, "doc_id string, toxic int, text string, family long")
    # Copies are one piece of evidence: of each family, the row with the smallest id.
    return found.groupBy("family").agg(F.min(F.struct("doc_id", "toxic", "text")).alias("r")).select("r.text", "r.toxic")


def family(text: str) -> int:
    """What copies and nearly all near copies have in common: the smallest hash of their five-word shingles."""
    found = _WORD.findall(text.lower())
    digest = xxhash.xxh64_intdigest
    grams = map(" ".join, zip(*(found[i:] for i in range(5)), strict=False)) if len(found) > 5 else [" ".join(found)]
    return min(map(digest, grams)) - (1 << 63)


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = texts_of(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.string()), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(family, texts)), pa.int64())],
            names=["doc_id", "toxic", "text", "family"],
        )


def _emit_tokens(batches: Iterator[pa.RecordBatch], prefix: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        token, toxic = [], []
        for text, label in zip(texts_of(batch), batch.column("toxic").to_pylist(), strict=True):
            found = {t for w in set(_WORD.findall(text.lower())) for t in tokens(w, prefix)}
            token.extend(found)
            toxic.extend([label] * len(found))
        yield pa.RecordBatch.from_arrays([pa.array(token, pa.string()), pa.array(toxic, pa.int32())], names=["token", "toxic"])


def term_scores(labelled: DataFrame, rules: ToxicityRules) -> DataFrame:
    """``token``, ``odds``, ``z``: log-odds with an informative Dirichlet prior, by documents that hold the token."""
    counts = materialise(
        labelled.transform(map_arrow, lambda b: _emit_tokens(b, rules.prefix), "token string, toxic int")
        .groupBy("token").agg(F.sum("toxic").alias("y1"), F.sum(1 - F.col("toxic")).alias("y0")),
        "token-counts",
    )
    total = counts.agg(F.sum("y1").alias("n1"), F.sum("y0").alias("n0")).first()
    n1, n0 = float(total["n1"] or 0), float(total["n0"] or 0)
    prior = rules.prior_share * (F.col("y1") + F.col("y0"))
    whole = rules.prior_share * (n1 + n0)

    def odds(y: Column, n: float) -> Column:
        return F.log((y + prior) / (n + whole - y - prior))

    return counts.filter(F.col("y1") > 0).select(
        "token", (odds(F.col("y1"), n1) - odds(F.col("y0"), n0)).alias("odds"),
        ((odds(F.col("y1"), n1) - odds(F.col("y0"), n0)) / F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior))).alias("z"),
    )


def _rate(shares: list[tuple[float, float]], drift: float) -> float:
    """lambda: the positive root of sum p exp(lambda s) = 1, by bisection."""
    rest = 1 - sum(p for p, _ in shares)
    excess = lambda x: rest * math.exp(-x * drift) + sum(p * math.exp(x * s) for p, s in shares) - 1
    low, high = 1e-6, 20.0
    if excess(low) >= 0:  # clean words gain on average: no root above zero
        return low
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (low, mid) if excess(mid) > 0 else (mid, high)
    return low


def _logistic(rows: list[tuple[float, int]]) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, by Newton steps with a small ridge."""
    slope, offset, ridge = 1.0, -2.0, 1.0
    for _ in range(60):
        g0, g1, h00, h01, h11 = 0.0, ridge * slope, 1e-6, 0.0, ridge
        for x, y in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, offset + slope * x))))
            w = max(p * (1 - p), 1e-9)
            g0, g1 = g0 + p - y, g1 + (p - y) * x
            h00, h01, h11 = h00 + w, h01 + w * x, h11 + w * x * x
        det = h00 * h11 - h01 * h01
        d0, d1 = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        scale = min(1.0, 2 / max(abs(d0), abs(d1), 1e-12))
        offset, slope = offset - scale * d0, max(0.0, slope - scale * d1)
        if max(abs(d0), abs(d1)) < 1e-8:
            break
    return slope, offset


def fit(docs: DataFrame, labels: DataFrame, rules: ToxicityRules = ToxicityRules()) -> Model:
    """The model of a bounded labelled sample; the driver sees its terms and one small row per sampled document."""
    labelled = materialise(_labelled(docs, labels, rules), "labelled")
    terms = (
        term_scores(labelled, rules).filter((F.col("z") >= rules.min_z) & (F.col("odds") >= rules.min_odds))
        .orderBy(F.desc("z"), "token").limit(rules.max_terms).collect()
    )
    plain = Model({r["token"]: r["odds"] for r in terms}, rules.prefix, rules.drift)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(plain)
        for batch in slices(batches):
            n, best, hits = [], [], []
            for text in texts_of(batch):
                words, passages = scorer.passages(text)
                n.append(words)
                best.append([s for _, _, s in passages])
                hits.append([s for w in _WORD.findall(text.lower()) if (s := scorer[w])] if passages else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(n, pa.int64()), pa.array(best, pa.list_(pa.float64())), pa.array(hits, pa.list_(pa.float64()))],
                names=["toxic", "n", "scores", "hits"],
            )

    seen = labelled.transform(map_arrow, found, "toxic int, n long, scores array<double>, hits array<double>")
    seen = materialise(seen, "sample-scores")
    rows = [(r["toxic"], r["n"], r["scores"]) for r in seen.select("toxic", "n", "scores").collect()]
    toxic = sum(t for t, _, _ in rows)
    if not rows or toxic in (0, len(rows)):
        share = toxic / len(rows) if rows else 0.0
        return Model({}, rules.prefix, rules.drift, offset=30.0 if share else -30.0)
    clean_words = sum(n for t, n, _ in rows if not t)
    in_clean = seen.filter("toxic = 0").select(F.explode("hits").alias("s")).groupBy("s").count().collect()
    # A hit that clean text never shows is given half an occurrence, so that lambda stays finite.
    shares = [(r["count"] / (clean_words + 1), r["s"]) for r in in_clean]
    if plain.terms:
        shares.append((0.5 / (clean_words + 1), sum(plain.terms.values()) / len(plain.terms)))
    rate = _rate(shares, rules.drift)
    level = min(plain.terms.values(), default=1.0)
    above = sum(1 for t, _, s in rows if not t for x in s if x >= level)
    per_word = min(1.0, (above + 0.5) * math.exp(rate * level) / (clean_words + 1))
    scorer = Scorer(Model(plain.terms, rules.prefix, rules.drift, rate, per_word))
    curve = [(math.log1p(scorer.evidence(n, [(0, 0, x) for x in s])), t) for t, n, s in rows]
    slope, offset = _logistic(curve)
    return Model(plain.terms, rules.prefix, rules.drift, rate, per_word, slope, offset)


def score_documents(docs: DataFrame, model: Model, folds: int = 5) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``passages`` (first word, end, score) of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for batch in slices(batches):
            found = [scorer.passages(t) for t in texts_of(batch)]
            scores = [scorer.score(scorer.evidence(n, p)) for n, p in found]
            passages = [[{"first": a, "end": b, "score": s} for a, b, s in p] for _, p in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(passages, kind)],
                names=["doc_id", "held_out", "score", "predicted", "passages"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "text").transform(
        map_arrow, run, f"doc_id {kind}, held_out boolean, score double, predicted int, passages array<struct<first: bigint, end: bigint, score: double>>"
    )
