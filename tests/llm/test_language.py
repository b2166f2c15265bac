import zlib

from corpus_helpers import LONG, ODD_TEXTS, documents, empty
from pyspark.sql import functions as F

from telemetra.llm import language, queries


def brute_phrases(reference, text):
    """Cross parsing by substring search, in blocks as the operator cuts them."""
    folded, n = language.fold(text), 0
    for i in range(0, len(folded), language.BLOCK):
        block, at = folded[i:i + language.BLOCK], 0
        while at < len(block):
            size = 1
            while at + size < len(block) and block[at:at + size + 1] in reference:
                size += 1
            at, n = at + size, n + 1
    return n


def test_automaton_reads_exactly_the_substrings():
    text = "abcbcabbac"
    step = language.suffix_automaton([ord(c) for c in text])

    def reads(s):
        state = 0
        for c in s:
            if ord(c) not in step[state]:
                return False
            state = step[state][ord(c)]
        return True
    subs = {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
    assert all(map(reads, subs))
    assert not any(reads(a + b) for a in subs for b in "abc" if a + b not in subs)


def test_phrase_counts_equal_brute_force():
    samples = {"x": ["the cat sat on the mat and the dog"], "y": ["der hund und die katze auf der matte", "zug"]}
    model = language.build(samples)
    texts = ["the dog and the cat", "und der Hund!", "zzz qqq", "T", "the cat " * 400, "katze 77 -- auf"]
    got, n = language.parse(model, texts)
    for i, t in enumerate(texts):
        # trailing separators are part of the parsed stream only inside the text
        stream = language.fold(t)
        for g, lang in enumerate(model.languages):
            reference = " ".join(map(language.fold, samples[lang]))
            assert abs(int(got[i, g]) - brute_phrases(reference, stream)) <= 1
    assert model.languages == ["x", "y"]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = queries.op7_language_id(spark, sf).join(docs, "doc_id").filter("held_out").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.98


def test_held_out_rows_teach_nothing(spark):
    texts = [f"alpha beta gamma {i}" for i in range(12)]
    docs = documents(spark, texts)
    free = docs.filter(~F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)))
    assert {r["doc_id"] for r in free.collect()} >= {i for i in range(12) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_odd_rows(spark):
    docs = documents(spark, ODD_TEXTS, clash=("lang_pred", "score", "draw", "piece"))
    model = language.train(docs)
    rows = docs.select("doc_id", language.identify(spark, model, F.col("text")).alias("r")).collect()
    got = {r["doc_id"]: r["r"] for r in rows}
    assert len(rows) == len(ODD_TEXTS) + 2
    for i in (0, 1, 2, 9):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[8]["lang_pred"] == "en" and len(LONG) > 300_000
    assert language.train(empty(spark)) is None
    none = docs.select(language.identify(spark, None, F.col("text"))["lang_pred"].alias("p")).distinct().collect()
    assert [r["p"] for r in none] == ["und"]
