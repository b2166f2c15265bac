"""Toxicity classifier: gradient-boosted trees over dense features, isotonic calibration.

**Lexicon.** A short fixed list of insults, and what the labels teach: hashes of words and
of word beginnings (``PREFIXES`` letters) whose documents are toxic far more often than
not. Letters are compared without case, inner marks and look-alikes (``id1ot``, ``i.diot``).

**Features** of a whole text: densities and counts of lexicon hits (sure and likely ones),
hits near a second-person pronoun (within ``NEAR`` tokens), the densest stretch of hits,
capitals, punctuation, obfuscated words.

**Training.** Labelled rows (a bounded, hash-chosen sample of ``ROWS``, a parameter) are cut
in three by a hash of the id: one part teaches the lexicon, one the trees
(``pyspark.ml`` GBT), one the isotonic calibration of their probability. All parts are
Spark jobs over the sample; the lexicon (``LEXICON`` entries at most) is broadcast.

**Scoring** is per row: features in Arrow batches, trees and calibration on the JVM. Null
texts count as empty. Without both kinds of label every score is the labelled share of
toxic rows (0 without labels). Repeated rows are scored alike; labels for the same id twice
count twice; rows whose label or id is null teach nothing.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from telemetra.llm import text_arrays as A
from telemetra.llm.common import cut, slices

ROWS = 12_000
TREES, DEPTH, STEP = 30, 4, 0.2
PREFIXES = (4, 5, 6, 7, 8)
LEXICON = 4000
MIN_DOCS = 3
NEAR = 6
STRETCH = 50
# fixed values: insults and second-person pronouns
INSULTS = ("idiot moron stupid scum trash worthless pathetic loser clown disgusting dumb fool jerk garbage filth vermin "
           "imbecile bastard bitch asshole shit fuck cunt retard whore slut dumm arschloch scheisse abschaum trottel "
           "connard salope merde abruti imbecile idiota estupido mierda basura cabron pendejo").split()
PRONOUNS = ("you your yours yourself u ya ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos "
            "ti tus usted ustedes vosotros os").split()
N_FEATURES = 16


@dataclass
class Lexicon:
    sure: np.ndarray
    likely: np.ndarray
    pronouns: np.ndarray


def _hashes(t: A.TextArrays) -> list[np.ndarray]:
    return [t.prefix_hash(), *(t.prefix_hash(n) for n in PREFIXES)]


def _held(values: np.ndarray, entries: np.ndarray) -> np.ndarray:
    if not len(entries):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(entries, values), len(entries) - 1)
    return (entries[at] == values) & (values != 0)


def features(lexicon: Lexicon, texts: list[str]) -> np.ndarray:
    parts = [_features(lexicon, texts[a:b]) for a, b in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))


def _features(lexicon: Lexicon, texts: list[str]) -> np.ndarray:
    t = A.TextArrays(texts)
    t.folded()
    tokens = np.maximum(t.t_count, 1)
    sure = likely = np.zeros(len(t.start), dtype=bool)
    for h in _hashes(t):
        sure, likely = sure | _held(h, lexicon.sure), likely | _held(h, lexicon.likely)
    likely &= ~sure
    you = _held(t.prefix_hash(), lexicon.pronouns)
    up, low, sign, digit, stop = (t.kinds_per_token(k) for k in (A.UPPER, A.LOWER, A.SIGN, A.DIGIT, A.STOP))
    # marks or digits inside a word: more kinds of character than its folded letters explain
    inner = (low + up >= 2) & ((digit > 0) | (sign + stop > 1)) & (t.f_length >= 3)
    hits = np.flatnonzero(sure | likely)
    near, stretch = np.zeros(t.n), np.zeros(t.n)
    if len(hits):
        where = np.flatnonzero(you)
        if len(where):
            right = np.minimum(np.searchsorted(where, hits), len(where) - 1)
            for j in (right, np.maximum(right - 1, 0)):
                close = (np.abs(where[j] - hits) <= NEAR) & (t.t_owner[where[j]] == t.t_owner[hits])
                near = np.maximum(near, np.bincount(t.t_owner[hits], weights=close, minlength=t.n))
        running = np.arange(len(hits))
        until = np.searchsorted(hits, hits + STRETCH)
        own_end = np.searchsorted(t.t_owner[hits], t.t_owner[hits], side="right")
        np.maximum.at(stretch, t.t_owner[hits], np.minimum(until, own_end) - running)
    n_sure, n_likely = t.per_text(sure), t.per_text(likely)
    whole = t.prefix_hash()
    kinds = A.distinct_per_text(whole[sure], t.t_owner[sure], t.n)
    chars = np.maximum(t.length, 1)
    letters = np.maximum(t.char_counts[:, A.UPPER] + t.char_counts[:, A.LOWER], 1)
    return np.column_stack([
        n_sure / tokens, n_likely / tokens, np.minimum(n_sure, 50), np.minimum(n_likely, 50), np.minimum(kinds, 50),
        (n_sure + n_likely) / tokens, near / tokens, np.minimum(near, 20), stretch, t.per_text(you) / tokens,
        t.char_counts[:, A.UPPER] / letters, t.per_text((up > 1) & (low == 0)) / tokens,
        t.char_counts[:, A.STOP] / chars, t.char_counts[:, A.SIGN] / chars, t.per_text(inner) / tokens,
        np.log1p(t.t_count)])


def _sorted(words: list[str]) -> np.ndarray:
    return np.unique(np.array([A.word_hash(w) for w in words], dtype=np.uint64))


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """From (text, toxic): document counts of every word and word beginning, added up by Spark."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, toxic = ["" if t is None else t for t in b["text"]], b["toxic"].to_numpy()
            for i, j in slices(texts):
                t = A.TextArrays(texts[i:j])
                t.folded()
                h = np.concatenate(_hashes(t))
                owner = np.tile(t.t_owner, 1 + len(PREFIXES))
                order = np.lexsort((owner, h))
                h, owner = h[order], owner[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                h, owner = h[new], owner[new]
                entry, first = np.unique(h, return_index=True)
                n = np.diff(np.append(first, len(h)))
                bad = np.add.reduceat(toxic[i:j][owner], first) if len(h) else np.zeros(0)
                yield pd.DataFrame({"h": entry.view(np.int64), "n": n, "bad": bad.astype(np.int64)})
    counts = labelled.select("text", "toxic").mapInPandas(run, "h long, n long, bad long").filter("h != 0") \
        .groupBy("h").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # smoothed share of toxic documents, less for entries of few documents
    share = (F.col("bad") + 0.2) / (F.col("n") + 1.0)
    top = counts.filter((F.col("bad") >= MIN_DOCS) & (share >= 0.45)).withColumn("share", share) \
        .orderBy(F.desc("share"), "h").limit(LEXICON).collect()
    taught = lambda rows: np.array([r["h"] for r in rows], dtype=np.int64).view(np.uint64)
    sure = np.unique(np.concatenate([_sorted(INSULTS), taught([r for r in top if r["share"] >= 0.75])]))
    return Lexicon(sure, np.unique(taught([r for r in top if r["share"] < 0.75])), _sorted(PRONOUNS))


@dataclass
class Model:
    lexicon: Lexicon | None
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    share: float


def with_features(df: DataFrame, lexicon: Lexicon, text: str, out: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(list(features(shared.value, ["" if t is None else t for t in s])))
    return df.withColumn(out, array_to_vector(run(F.col(text))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          rows: int = ROWS) -> Model:
    """``labels`` (id, label): the rows that may be learned from."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("toxic")).dropna()
    n = known.count()
    draw = F.pmod(F.xxhash64("id", F.lit("toxic")), F.lit(1 << 30))
    chosen = known if n <= rows else known.filter(draw < int((1 << 30) * rows / n))
    sample = cut(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
                 .join(F.broadcast(chosen), "id")       # at most about `rows` ids
                 .withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.lit(10))), "toxicity-sample")
    totals = sample.agg(F.count("*"), F.sum("toxic")).first()
    share = (totals[1] or 0.0) / totals[0] if totals[0] else 0.0
    if not 0 < share < 1:
        return Model(None, None, None, share)
    lexicon = learn_lexicon(sample.filter("part < 4"))
    vectors = cut(with_features(sample.filter("part >= 4"), lexicon, "text", "features").select("part", "toxic", "features"),
                  "toxicity-features")
    fit, held = vectors.filter("part < 8"), vectors.filter("part >= 8")
    both = lambda df: df.agg(F.min("toxic"), F.max("toxic")).first()
    if tuple(both(fit)) != (0.0, 1.0):
        return Model(None, None, None, share)
    trees = GBTClassifier(labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=5, minInstancesPerNode=3,
                          cacheNodeIds=False, maxMemoryInMB=64).fit(fit)
    curve = None
    if tuple(both(held)) == (0.0, 1.0):
        points = trees.transform(held).select("toxic", vector_to_array("probability")[1].alias("p"))
        curve = IsotonicRegression(labelCol="toxic", featuresCol="p").fit(points)
    return Model(lexicon, trees, curve, share)


def scored(model: Model, docs: DataFrame, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score column ``out``; the text column is not kept."""
    keep = [c for c in docs.columns if c != text]
    if model.trees is None:
        return docs.select(*keep, F.lit(float(model.share)).alias(out))
    rows = docs.select(F.struct(*keep).alias("_kept"), F.col(text).alias("_text"))
    rows = model.trees.transform(with_features(rows, model.lexicon, "_text", "features").drop("_text")) \
        .withColumn("p", vector_to_array("probability")[1])
    if model.curve is not None:
        rows = model.curve.transform(rows.select("_kept", "p").withColumnRenamed("p", model.curve.getFeaturesCol())) \
            .withColumn("p", F.col(model.curve.getPredictionCol()))
    return rows.select("_kept.*", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("p"))).alias(out))

