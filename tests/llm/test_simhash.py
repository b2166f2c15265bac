import xxhash
from corpus_helpers import ODD_TEXTS, corpus, documents, empty  # noqa: F401
from pyspark.sql import functions as F

from telemetra.llm import queries, simhash

CLASH = ("fp", "component_id", "variant", "id", "text_hash", "root", "a", "b", "_h")


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """doc_id -> smallest doc_id reachable over links of at most two bits."""
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark, corpus):
    got = {r["doc_id"]: r for r in queries.op8_simhash(spark, "/root/testdata/sf0.001").collect()}
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in corpus}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(fps)


def test_balls_link_what_all_pairs_link(spark):
    import random
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = set(base)
    for b in base:                       # chains: each two bits from the last
        x = b
        for _ in range(6):
            x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            fps.add(x)
    fps |= {0, 1, 3, (1 << 64) - 1, (1 << 63)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    links = simhash.ball_links(df)
    assert links.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 2).isEmpty()
    roots = {r["node"]: r["root"] for r in simhash.connected(links).collect()}
    brute = brute_components({signed(x): x for x in fps})
    groups = lambda m: sorted(sorted(k for k in fps if m(signed(k)) == v) for v in {m(signed(k)) for k in fps})
    assert groups(lambda n: roots.get(n, n)) == groups(brute.get)


def test_long_chain_of_links_is_one_component(spark):
    links = spark.range(1, 400).select(F.col("id").alias("b"), (F.col("id") - 1).alias("a"))
    roots = simhash.connected(links).collect()
    assert {r["root"] for r in roots} == {0} and len(roots) == 399


def test_odd_rows(spark):
    docs = documents(spark, ODD_TEXTS, clash=CLASH)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["fp"] == by_id[1]["fp"] == by_id[2]["fp"] == 0
    assert by_id[1]["component_id"] == 0 and by_id[5]["component_id"] == 4
    assert by_id[None]["component_id"] is None
    kept = simhash.keep_one(docs)
    assert set(kept.columns) == set(docs.columns)
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([0, 3, 4, 6, 7, 8, 9, None], key=str)
    assert simhash.near_duplicates(empty(spark, CLASH)).isEmpty() and simhash.keep_one(empty(spark)).isEmpty()
