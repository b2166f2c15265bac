"""Quality, toxicity and the word model: held-out accuracy, brute force, odd rows."""
import itertools
import math
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus_helpers import ODD_TEXTS, corpus, documents, empty  # noqa: F401
from pyspark.sql import functions as F

from telemetra.llm import hmm, quality_pu, queries, text_arrays, toxicity
from telemetra.llm.common import SHUFFLE_CLEANUP
from telemetra.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.01"


def held_out(spark, rows, label, sf=SF):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return rows.join(labels, "doc_id").filter("held_out").select("score", "predicted", F.col(label).alias("y")).collect()


def area(rows):
    """Chance that a positive row scores above a negative one."""
    p, n = [r["score"] for r in rows if r["y"] == 1], [r["score"] for r in rows if r["y"] == 0]
    return sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n))


def test_quality_held_out(spark):
    rows = held_out(spark, queries.op4_quality_pu(spark, SF), "quality")
    assert area(rows) > 0.95 and sum(r["predicted"] == r["y"] for r in rows) / len(rows) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_class_prior_and_risk():
    rng = np.random.default_rng(0)
    pos, neg = rng.normal(1.5, 1, (3000, 4)), rng.normal(-1.5, 1, (3000, 4))
    unlabelled = np.concatenate([pos[:1200], neg[:1800]])
    prior = quality_pu.estimate_prior(pos[1200:], unlabelled)
    assert 0.33 < prior < 0.5
    model = quality_pu.fit(pos[1200:], unlabelled)
    x, y = np.concatenate([rng.normal(1.5, 1, (500, 4)), rng.normal(-1.5, 1, (500, 4))]), np.repeat([1, 0], 500)
    assert ((quality_pu.probability(model, x) >= 0.5) == y).mean() > 0.95
    assert quality_pu.fit(np.zeros((0, 4)), unlabelled) is None
    assert (quality_pu.probability(None, x) == 0.5).all()


def test_quality_odd_rows(spark):
    docs = documents(spark, ODD_TEXTS, clash=("score", "_id", "_text", "h"))
    model = quality_pu.train(docs, docs.filter("doc_id < 5").select("doc_id"))
    rows = docs.select("doc_id", quality_pu.scored(spark, model, F.col("text")).alias("s")).collect()
    assert len(rows) == len(ODD_TEXTS) + 2 and all(0 <= r["s"] <= 1 for r in rows)
    assert quality_pu.train(empty(spark), empty(spark).select("doc_id")) is None


def test_features_do_not_depend_on_the_batch():
    texts = ["" if t is None else t for t in ODD_TEXTS]
    alone = np.concatenate([quality_pu.features([t]) for t in texts])
    assert np.allclose(quality_pu.features(texts), alone)
    lexicon = toxicity.Lexicon(toxicity._sorted(["one", "café"]), toxicity._sorted(["word5"]), toxicity._sorted(["and5"]))
    alone = np.concatenate([toxicity.features(lexicon, [t]) for t in texts])
    assert np.allclose(toxicity.features(lexicon, texts), alone) and alone.shape[1] == toxicity.N_FEATURES


def test_folded_words_match_without_marks_and_look_alikes():
    h = text_arrays.word_hash("idiot")
    for word in ("IDIOT", "id1ot", "i.d.i.o.t", "idiot,"):
        assert text_arrays.word_hash(word) == h, word
    assert text_arrays.word_hash("idiots", 5) == h and text_arrays.word_hash("idio") != h


def test_second_person_nearness():
    lexicon = toxicity.Lexicon(toxicity._sorted(["scum"]), np.zeros(0, np.uint64), toxicity._sorted(["you"]))
    near, far = toxicity.features(lexicon, ["you are scum", "you " + "a b c d e f g h i j " + "scum"])[:, 7]
    assert (near, far) == (1, 0)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = held_out(spark, queries.op6_toxicity_gbt(spark, sf), "toxic", sf)
    assert area(rows) > 0.93 and sum(r["predicted"] == r["y"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_odd_rows(spark):
    texts = ODD_TEXTS + [f"you are scum number {i}" for i in range(40)] + [f"a fine day number {i}" for i in range(60)]
    docs = documents(spark, texts, clash=("score", "features", "part", "p", "id", "toxic"))
    labels = spark.createDataFrame([(i, int(10 <= i < 50)) for i in range(len(texts))] + [(None, 1), (3, None)],
                                   "doc_id long, toxic int")
    for known in (labels, labels.filter("toxic = 0"), labels.limit(0)):
        model = toxicity.train(docs, known)
        rows = toxicity.scored(model, docs.select("doc_id", "text", "source")).collect()
        assert len(rows) == len(texts) + 2 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.scored(model, empty(spark)).isEmpty()


def test_word_model_base_score_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in queries.op10_hmm_lm(spark, SF).collect()}
    counts, tokens = Counter(), {}
    for r in docs:
        tokens[r["doc_id"]] = (r["text"] or "").encode().lower().split() + [b"\n"]
        if zlib.crc32(str(r["doc_id"]).encode()) % 10:
            counts.update(tokens[r["doc_id"]])
    n, v = sum(counts.values()), len(counts)
    base = model = size = 0
    for i, ws in tokens.items():
        row = got[i]
        want = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert abs(row["base_score"] - want) < 1e-7 * max(1, abs(want))
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(ws), sum(w in counts for w in ws), n)
        assert row["score"] < 0 and row["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)
        if row["held_out"]:
            base, model, size = base + row["base_score"], model + row["score"], size + len(ws)
    assert model / size > base / size          # states help on unseen text


def brute_likelihood(p, seq):
    k = len(p.start)
    total = 0.0
    for path in itertools.product(range(k), repeat=len(seq)):
        x = p.start[path[0]] * p.emit[path[0], seq[0]]
        for a, b, s in zip(path, path[1:], seq[1:]):
            x *= p.step[a, b] * p.emit[b, s]
        total += x
    return math.log(total)


def test_forward_recursion_is_exact():
    p = hmm.Parameters.first(5, 3, seed=1)
    seqs = [np.array(s) for s in ([0], [1, 2], [4, 4, 0, 3], [2, 1, 0, 1, 2, 3])]
    assert np.allclose(hmm.log_likelihood(p, seqs), [brute_likelihood(p, s) for s in seqs])
    assert len(hmm.log_likelihood(p, [])) == 0


def test_baum_welch_never_lowers_the_likelihood(spark):
    rng = np.random.default_rng(2)
    seqs = [np.array([(i // 3 + rng.integers(0, 2)) % 6 for i in range(rng.integers(1, 60))]) for _ in range(80)]
    df = spark.createDataFrame([(bytearray(s.astype("<u4").tobytes()), [], bytearray()) for s in seqs],
                               "ids binary, rare array<binary>, rare_cls binary").repartition(3)
    last = hmm.log_likelihood(hmm.Parameters.first(6 + hmm.CLASSES, 3), seqs).sum()
    for rounds in (1, 2, 4):
        p, counts, rare = hmm.baum_welch(df, np.arange(6), 6, 3, rounds)
        now = hmm.log_likelihood(p, seqs).sum()
        assert now > last - 1e-6 and rare.isEmpty()
        assert np.allclose(counts[:6].sum(1), np.bincount(np.concatenate(seqs), minlength=6), atol=1e-3)
        last = now


def small_alphabet(monkeypatch):
    """Make most words rare, and tie most of those with an id, though the table is small."""
    monkeypatch.setattr(hmm, "FREQUENT", 5e-4)
    monkeypatch.setattr(hmm, "OWN", 4e-3)


def plain_model(texts, train, states=hmm.STATES, rounds=hmm.ROUNDS):
    """log10 probability of each text, and each state's whole mass: one document at a time, words by dictionaries."""
    docs = [(t or "").encode().lower().split() + [hmm.END] for t in texts]
    counts = Counter(w for d, known in zip(docs, train) if known for w in d)
    n, v = sum(counts.values()), len(counts)
    alone = [hmm.END] + sorted((w for w in counts if w != hmm.END and counts[w] > n * max(hmm.OWN, hmm.FREQUENT)),
                               key=lambda w: (-counts[w], w))
    symbol = lambda w: alone.index(w) if w in alone else len(alone) + zlib.crc32(w[-3:]) % hmm.CLASSES
    symbols = {w: symbol(w) for d in docs for w in d}
    p = hmm.Parameters.first(len(alone) + hmm.CLASSES, states)
    for _ in range(rounds):
        start, step, by_word = np.zeros(states), np.zeros((states, states)), {w: np.zeros(states) for w in counts}
        for d, known in zip(docs, train):
            for at in range(0, len(d) if known else 0, hmm.SEGMENT):
                e = [p.emit[:, symbols[w]] for w in d[at:at + hmm.SEGMENT]]
                alpha = [(p.occupancy if at else p.start) * e[0]]
                for x in e[1:]:
                    alpha[-1] = alpha[-1] / alpha[-1].sum()
                    alpha.append((alpha[-1] @ p.step) * x)
                beta = np.ones(states)
                for t in range(len(e) - 1, -1, -1):
                    gamma = alpha[t] * beta
                    by_word[d[at + t]] += gamma / gamma.sum()
                    if t:
                        joint = p.step * np.outer(alpha[t - 1], e[t] * beta)
                        step += joint / joint.sum()
                        beta = p.step @ (e[t] * beta)
                        beta /= beta.sum()
                    elif not at:
                        start += gamma / gamma.sum()
        tied = np.zeros((states, len(alone) + hmm.CLASSES))
        for w, x in by_word.items():
            tied[:, symbols[w]] += x
        p = hmm.Parameters.from_counts(start, step, tied)
    size, slots = sum(by_word.values()), n + 0.1 * (v + hmm.CLASSES)
    emit = {w: (n * (by_word[w] + hmm.SHRINK * counts[w]) / (size + hmm.SHRINK * n) + 0.1) / slots for w in counts}
    ends = tied[:, len(alone):].T
    ends = ends + hmm.SHRINK * ends.sum(1, keepdims=True) + 1
    unknown = 0.1 * hmm.CLASSES * ends / ends.sum(0) / slots
    out = []
    for d in docs:
        a, total = p.start, 0.0
        for t, w in enumerate(d):
            a = (a @ p.step if t else a) * emit.get(w, unknown[symbols[w] - len(alone)])
            total += math.log10(a.sum())
            a = a / a.sum()
        out.append(total)
    return out, sum(emit.values()) + unknown.sum(0)


def test_word_model_equals_plain_training(spark, corpus, monkeypatch):
    small_alphabet(monkeypatch)
    texts = [r["text"] for r in corpus] + ["", None, "Never seen wordsing here"]
    train = [i % 7 != 3 for i in range(len(corpus))] + [False, True, False]
    docs = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(zip(texts, train))],
                                 "doc_id long, text string, train boolean").repartition(5)
    v = hmm.vocabulary(hmm.word_counts(docs.filter("train")))
    assert 1 < v.alone < len(v.own) < v.distinct / 2            # single symbols, tied ids, rare words
    want, mass = plain_model(texts, train)
    assert np.allclose(mass, 1)
    got = {r["doc_id"]: r["score"] for r in hmm.score(docs, "train").collect()}
    for i, w in enumerate(want):
        assert abs(got[i] - w) < 1e-3 * max(1, abs(w)), i


def test_expected_counts_cover_every_word(spark, corpus, monkeypatch):
    small_alphabet(monkeypatch)
    docs = spark.createDataFrame([(r["doc_id"], r["text"], True) for r in corpus], "doc_id long, text string, train boolean")
    counts = hmm.word_counts(docs)
    v = hmm.vocabulary(counts)
    rows = hmm.symbolise(docs, spark.sparkContext.broadcast(v), "doc_id", "text", "train")
    _, cells, rare = hmm.baum_welch(rows, v.symbol, v.alone, packed=v.packed)
    c = {bytes(r["word"]): r["c"] for r in counts.collect()}
    assert np.allclose(cells[:len(v.own)].sum(1), [c[w] for w in v.own], atol=0.01)
    found = {bytes(r["key"]): r for r in rare.collect()}
    assert set(found) == set(c) - set(v.own)                    # a row for every word, however rare
    for w, r in found.items():
        assert v.packed.unpack([np.array([r[x]]) for x in v.packed.names]).sum() == c[w] * hmm.UNIT


@pytest.mark.parametrize("most", [1, 170, 12_345, 10**9])
def test_packed_counts_add_up(most):
    rng = np.random.default_rng(most)
    packed = hmm.Packed(most)
    parts = [rng.dirichlet(np.full(hmm.STATES, 0.2), 50) * n for n in (most - most // 3, most // 3)]
    numbers = [packed.pack(np.rint(e.sum(1)).astype(np.int64), e) for e in parts]
    units = packed.unpack([a + b for a, b in zip(*numbers)])
    assert (units.sum(1) == most * hmm.UNIT).all() and (units >= 0).all()
    assert np.abs(units / hmm.UNIT - sum(parts)).max() <= 2 * hmm.STATES / hmm.UNIT


@pytest.mark.parametrize("share", [True, False])
def test_word_model_odd_rows(spark, share, monkeypatch):
    monkeypatch.setattr(hmm, "FREQUENT", 1e-3)
    clash = ("row", "id", "n", "c", "word", "ll", "ids", "key", "met", "score")
    docs = documents(spark, ODD_TEXTS, clash=clash).withColumn("train", F.lit(share))
    rows = hmm.score(docs, "train").collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_tokens"] == 1 and by_id[0]["score"] == by_id[1]["score"]
    assert by_id[8]["n_tokens"] == 60_001 and math.isfinite(by_id[8]["score"])
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in rows)
    assert hmm.score(empty(spark).withColumn("train", F.lit(True)), "train").isEmpty()


def test_words_of_a_batch_are_those_of_each_text():
    texts = [*ODD_TEXTS, " A\x0bB\x0cC\x1cd\x85e\u00a0F\u2003\u0130 ", "x", "\r\n"]
    for part in (texts, texts[:3], [None], []):
        array = pa.array([None, *part], pa.string()).slice(1)
        flat, n = hmm.word_batch(array)
        assert flat.to_pylist() == [w for t in part for w in hmm.words(t)]
        assert n.tolist() == [len(hmm.words(t)) for t in part]


def test_word_model_keeps_only_the_tables_that_it_reads(spark, monkeypatch):
    monkeypatch.setattr(hmm, "FREQUENT", 1e-3)
    folder, before = ensure_checkpoint_dir(spark).removeprefix("file:"), spark.conf.get(SHUFFLE_CLEANUP, None)
    there = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    docs = documents(spark, ODD_TEXTS).withColumn("train", F.col("doc_id") != 3)
    assert hmm.score(docs.fillna(True, ["train"]), "train").count() == len(ODD_TEXTS) + 2
    kept = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - there if name.startswith("hmm-")}
    assert kept == {"hmm-rows", "hmm-known", "hmm-met"}      # counts and cells are gone
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
