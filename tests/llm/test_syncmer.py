import hashlib

from corpus_helpers import ODD_TEXTS, corpus, documents, empty  # noqa: F401
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from telemetra.llm import queries, syncmer


def test_query(spark, corpus):
    rows = {r["doc_id"]: r for r in queries.op9_syncmer(spark, "/root/testdata/sf0.001").collect()}
    texts = [r["text"] or "" for r in corpus]
    assert len(rows) == len(corpus)
    better = 0
    for i, r in enumerate(corpus):
        got, n = rows[r["doc_id"]], len(texts[i])
        edited = texts[i][:n - n // 4] + texts[(i + 1) % len(texts)][:n // 4]
        assert got["n_chars"] == n and got["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got["near_edited"] <= 1 and 0 <= got["near_next"] <= 1
        better += got["near_edited"] > got["near_next"]
    assert better > 0.95 * len(corpus)
    by_text = {}
    for i, r in enumerate(corpus):
        assert by_text.setdefault(texts[i], rows[r["doc_id"]]["fingerprint"]) == rows[r["doc_id"]]["fingerprint"]


def test_anchors_equal_brute_force(spark):
    text = " ".join("abcdefgh"[i % 8] * (1 + i * i % 53) for i in range(120))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    hashes = df.select(syncmer.token_hashes(F.col("text")).alias("h")).first()["h"]
    pairs = spark.createDataFrame([(i, hashes[i], hashes[i + 1]) for i in range(len(hashes) - 1)], "i int, a long, b long")
    inner = hashes if syncmer.S == 1 else [r["g"] for r in pairs.select("i", F.xxhash64("a", "b").alias("g")).orderBy("i").collect()]
    w = syncmer.K - syncmer.S + 1
    want = [i for i in range(len(hashes) - syncmer.K + 1)
            if min(inner[i:i + w]) in (inner[i], inner[i + w - 1])]
    got = [r["position"] for r in syncmer.anchors(df).orderBy("position").collect()]
    assert got == want
    assert max(b - a for a, b in zip(got, got[1:])) <= w


def test_anchors_need_no_context_and_match_by_position(spark):
    passage = " ".join("abcdefg"[i % 7] * (1 + i * 7 % 101) for i in range(80))
    left = spark.createDataFrame([(1, passage)], "doc_id long, text string")
    right = spark.createDataFrame([(2, "some other words come first " + passage + " and some after")], "doc_id long, text string")
    a, b = syncmer.anchors(left), syncmer.anchors(right)
    best = syncmer.match_positions(a, b).orderBy(F.desc("matches")).first()
    assert (best["left_id"], best["right_id"], best["offset"], best["matches"]) == (1, 2, 5, a.count())


def test_next_text_across_blocks(spark):
    ids = [0, 1, 63, 64, 65, 5000, 5001, 10 ** 12, -7]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    got = {r["id"]: r["next"] for r in syncmer.with_next(df, "doc_id", "text", F.length).collect()}
    order = sorted(ids)
    assert got == {i: f"text {order[(k + 1) % len(order)]}" for k, i in enumerate(order)}


def test_next_text_of_sparse_text_and_null_ids(spark):
    sparse = [(-1) ** i * (i * 0x9E3779B97F4A7C15 % (1 << 62)) for i in range(300)]
    df = spark.createDataFrame([(i, f"text {i}") for i in sparse], "doc_id long, text string").repartition(7)
    got = {r["id"]: r["next"] for r in syncmer.with_next(df, "doc_id", "text", F.length).collect()}
    order = sorted(sparse)
    assert got == {i: f"text {order[(k + 1) % len(order)]}" for k, i in enumerate(order)}
    names = [f"id{i * 37 % 101}" for i in range(90)]
    df = spark.createDataFrame([(i, f"text {i}") for i in names], "doc_id string, text string").repartition(5)
    got = {r["id"]: r["next"] for r in syncmer.with_next(df, "doc_id", "text", F.length).collect()}
    order = sorted(names)
    assert got == {i: f"text {order[(k + 1) % len(order)]}" for k, i in enumerate(order)}
    texts = sorted(f"{'same beginning of many texts ' * (i % 2)}{i:03d}" for i in range(80))
    rows = [(None, t) for t in texts] + [(5, "five"), (5, "a five"), (-3, "minus")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {(r["id"], r["text"]): r["next"] for r in syncmer.with_next(df, "doc_id", "text", F.length).collect()}
    order = [(None, t) for t in texts] + [(-3, "minus"), (5, "a five"), (5, "five")]
    assert got == {x: order[(k + 1) % len(order)][1] for k, x in enumerate(order)}
    assert len(syncmer.fingerprint_report(df.withColumn("doc_id", F.col("doc_id").cast("string"))).collect()) == len(rows)


def test_short_and_unspaced_texts_keep_their_likeness(spark):
    """A quarter replaced: texts of a few tokens, of a script without blanks and of long runs stay alike."""
    import random
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9)))
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(n))
    run = lambda n: "".join(rng.choice("abcXYZ0189+/;{}") for _ in range(n))
    rows = [(f"words{n}", " ".join(word() for _ in range(n))) for n in range(5, 21) for _ in range(6)]
    rows += [("han", han(rng.randrange(10, 200))) for _ in range(40)] + [("run", run(rng.randrange(80, 400))) for _ in range(40)]
    df = spark.createDataFrame([(i, kind, t) for i, (kind, t) in enumerate(rows)], "doc_id long, kind string, text string")
    got = {r["doc_id"]: r for r in syncmer.fingerprint_report(df).collect()}
    near = {}
    for i, (kind, _) in enumerate(rows):
        near.setdefault(kind, []).append(got[i]["near_edited"])
        assert got[i]["near_edited"] > got[i]["near_next"] and got[i]["near_edited"] > 0.1, rows[i]
    assert all(sum(v) / len(v) > 0.2 for v in near.values()), near


def test_cuts_depend_on_neighbours_alone(spark):
    """A character put in front of a run without blanks moves no later anchor."""
    import random
    rng = random.Random(4)
    run = "".join(rng.choice("abcXYZ0189+/;") for _ in range(600))
    rows = [(1, run), (2, "q" + run), (3, run[:300] + "7" + run[300:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = {i: {r["hash"] for r in syncmer.anchors(df).filter(f"doc_id = {i}").collect()} for i in (1, 2, 3)}
    assert len(held[1] - held[2]) <= syncmer.K and len(held[1] - held[3]) <= 2 * syncmer.K and len(held[1]) > 100


def test_odd_rows(spark):
    clash = ("id", "block", "own", "next", "fingerprint", "edited", "top")
    rows = syncmer.fingerprint_report(documents(spark, ODD_TEXTS, clash=clash)).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_chars"] == 0 and by_id[0]["fingerprint"] == "" and by_id[0]["near_edited"] == 1.0
    assert by_id[4]["fingerprint"] == by_id[5]["fingerprint"] and by_id[4]["near_next"] == 1.0
    assert by_id[6]["n_chars"] == len(ODD_TEXTS[6])
    assert syncmer.fingerprint_report(empty(spark)).isEmpty()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab c", max_size=12), min_size=1, max_size=6))
def test_next_of_any_list(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["next"] for r in syncmer.with_next(df, "doc_id", "text", F.length).collect()}
    assert got == {i: texts[(i + 1) % len(texts)] for i in range(len(texts))}
