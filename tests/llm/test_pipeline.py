import sys

from corpus_helpers import ODD_TEXTS, documents, empty
from pyspark.sql import functions as F

import corpus_pipeline
from telemetra.llm import language, queries
from telemetra.llm.common import cut
from test_packing import check
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as entry
    names = list(entry.queries())
    assert [n for n in names if n.startswith("op")] == list(queries.queries()) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_run_equals_brute_force(spark):
    """Each stage against a plain computation over its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = dict(corpus_pipeline.STAGES)
    languages = cut(found["language_id"](spark, docs, SF), "t")
    with_letters = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in languages.collect()} == with_letters
    lines = cut(found["line_dedup"](spark, languages, SF), "t")
    assert lines.count() == languages.count()
    before = {r["doc_id"]: r["text"] for r in languages.collect()}
    for r in lines.collect():
        assert r["n_chars"] == len(r["text"])
        rest = iter(before[r["doc_id"]].split("\n"))
        assert all(any(x == y for y in rest) for x in r["text"].split("\n") if r["text"])   # a subsequence of its lines
    kept = cut(found["near_duplicates"](spark, lines, SF), "t")
    groups = brute_components({r["doc_id"]: brute_fingerprint(r["text"]) for r in lines.collect()})
    assert {r["doc_id"] for r in kept.collect()} == set(groups.values())
    clean = cut(found["decontaminate"](spark, kept, SF), "t")
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r["doc_id"] for r in kept.collect() if any(b in r["text"] for b in bench)}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in kept.collect()} - leaked
    assert all(f.columns == list(docs.columns) for f in (languages, lines, kept, clean))
    from tokenizers import Tokenizer
    reference = Tokenizer.from_file(queries.vocabulary())
    ids = {r["doc_id"]: reference.encode(r["text"], add_special_tokens=False).ids + [1] for r in clean.collect()}
    pieces = found["packing"](spark, clean, SF).collect()
    covered = check(pieces, ids)
    assert {i: sum(c.values()) for i, c in covered.items()} == {i: len(x) for i, x in ids.items()}
    whole = corpus_pipeline.run(spark, SF).collect()
    assert {(r["doc_id"], r["doc_tokens"]) for r in whole} == {(i, len(x)) for i, x in ids.items()}


def test_odd_rows_and_empty_tables(spark):
    docs = documents(spark, ODD_TEXTS, clash=("lang_pred", "score", "n_lines", "_h", "item_id", "fp", "key"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert {r["doc_id"] for r in docs.collect()} == {None, 3, 4, 6, 7, 8}
    assert docs.filter(F.col("lang") == language.UNDETERMINED).isEmpty()
    none = empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        none = cut(stage(spark, none, SF), name)
        assert none.isEmpty(), name


def test_rest_does_not_import_the_subpackage():
    import subprocess
    code = "import sys, telemetra.plans.catalog; sys.exit(any(m.startswith('telemetra.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], env={**__import__('os').environ, "PYTHONPATH": sys.path[0]}).returncode == 0
