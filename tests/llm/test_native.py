"""Line dedup, secret scan, decontamination: against DuckDB SQL, brute force and hand cases."""
import hashlib
import math
import re

import duckdb
import pytest
from corpus_helpers import ODD_TEXTS, SF, corpus, documents, empty  # noqa: F401

from telemetra.llm import decontaminate, line_dedup, queries, secrets


def same(df, con, sql):
    want = con.execute(sql)
    cols = sorted(d[0] for d in want.description)
    assert sorted(df.columns) == cols
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key) == sorted(want, key=key)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ["op1_line_dedup", "op2_secret_scan", "op3_decontaminate"])
def test_queries_equal_sql(spark, con, name):
    same(queries.queries()[name](spark, SF), con, queries.oracle_sql()[name])


def pages(spark):
    rows = [(i, f"own line {i}\n  Cookie notice \n\nbody {i}", "big", 1) for i in range(100)]
    rows += [(200 + i, "copied page\nall the same", "big", 1) for i in range(30)]
    rows += [(300, "Cookie notice", "small", 1), (301, "Cookie notice\nx", "small", 1),
             (302, None, "big", 1), (303, "", None, 1), (304, "Cookie notice", "", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines int")


def test_line_dedup_hand_case_and_both_plans(spark, monkeypatch):
    def run():
        return {r["doc_id"]: r for r in line_dedup.drop_boilerplate(pages(spark)).collect()}
    got = run()
    assert got[7]["text"] == "own line 7\n\nbody 7" and (got[7]["n_lines"], got[7]["n_dropped"]) == (4, 1)
    assert got[205]["text"] == "copied page\nall the same"            # copies are one page
    assert got[300]["text"] == "Cookie notice"                        # too few pages to tell
    assert got[302]["text"] is None and got[302]["n_lines"] == 0 and got[303]["text"] == ""
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", -1)
    assert run() == got


def test_line_dedup_odd_rows(spark, con):
    rows = line_dedup.drop_boilerplate(documents(spark, ODD_TEXTS, clash=("n_lines", "host", "lines", "_kept", "row", "_host", "_lines", "_salt"))).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == {**dict(enumerate(ODD_TEXTS)), None: "no id here"}
    assert len(rows) == len(ODD_TEXTS) + 2
    assert line_dedup.drop_boilerplate(empty(spark)).isEmpty()


ASSIGN = re.compile(secrets.ASSIGN)


def brute_base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return spans


def brute_entropy(text, window=secrets.WINDOW):
    best = 0.0
    for i in range(len(text) - window + 1):
        part = text[i:i + window]
        best = max(best, -sum(part.count(c) / window * math.log2(part.count(c) / window) for c in set(part)))
    return best


def render(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_secret_query_equals_brute_force(spark, corpus):
    got = {r["doc_id"]: r for r in queries.op2_secret_scan(spark, SF).collect()}
    for r in corpus:
        base, row = brute_base(r["text"] or ""), got[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(render(base).encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(s[1] == k for s in base) for k in range(3)]


CASES = {
    "\U0001F600 é PassWord = 'abcDEF123456789' and token:short": "assign:4:31",
    "secret=token=abcdefghijklmnop": "assign:0:29",
    "password: token='abcdefghijklmnop'": "",
    "AKIAABCDEFGHIJKLMN1 AKIAABC": "access:0:19",
    "ffff0000ffff0000 and 0123456789abcde": "hex:0:16",
    "api_key=0123456789abcdef0123": "assign:0:28,hex:8:28",
    "see Zx9Qk2Lm7Vt4Rb8Np1Wc6Yd here": "entropy:4:27",
    "see aaaaaaaaaaaaaaaaaaaaaaaaa1 and AAAAAAAAAAAAAAAAAAAAAAAAA1 here": "hex:4:30",
    "an EXAMPLEZx9Qk2Lm7Vt4Rb8Np1Wc6Yd": "",
    "id 123e4567-e89b-12d3-a456-426614174000.": "",
    "a verylongwordwithoutanydigitsatallinside": "",
}


def test_secret_hand_cases(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.scan_report(df).collect()}
    assert got == dict(enumerate(CASES.values()))


def test_secret_sql_tells_the_hand_cases():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(x) for x in enumerate(CASES)] + [[99, None]])
    got = dict(con.execute(f"SELECT doc_id, spans FROM ({secrets.sql()})").fetchall())
    assert got == {**dict(enumerate(CASES.values())), 99: ""}


def test_secrets_with_names_padding_and_signs_are_told(spark):
    """Names, values and joined words are judged apart, by the operator and by its SQL."""
    import base64
    import random
    rng = random.Random(3)
    key = "wJ4lrXUtnF3MIbK7MD9NGcbPxRf1CYzQ2vT8hLsA"
    coded = [base64.b64encode(rng.randbytes(n)).decode() for n in (16, 64) for _ in range(150)]
    coded += [f(rng.randbytes(32)).decode() for f in (base64.b64encode, base64.urlsafe_b64encode) for _ in range(150)]
    told = [f"AWS_SECRET_ACCESS_KEY={key}", f"MY_APP_PRIVATE_KEY={key}", f"EXAMPLE_APP_KEY={key}",
            "AccountKey=" + base64.b64encode(rng.randbytes(64)).decode(), "/" + key, "+" + key, key[:20] + "//" + key[20:],
            key[:20] + "++" + key[20:], f"/srv/app/keys/{key}", *coded]
    not_told = ["MY_APP_PRIVATE_KEY=your_key_1234_goes_here_now", "path/to/some/module_two/file2name",
                "KEY_OF_THE_APP=123e4567-e89b-12d3-a456-426614174000", "MY_APP_PRIVATE_KEY=short1",
                "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"]
    df = spark.createDataFrame([(i, f"see {t} here") for i, t in enumerate(told + not_told)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.scan_report(df).collect()}
    missed = [t for i, t in enumerate(told) if got[i] != f"entropy:4:{4 + len(t)}"]
    assert not [t for t in missed if t not in coded] and len(missed) <= len(coded) // 50, missed   # chance low entropy
    assert [got[len(told) + i] for i in range(len(not_told))] == [""] * len(not_told)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in df.collect()])
    assert dict(con.execute(f"SELECT doc_id, spans FROM ({secrets.sql()})").fetchall()) == got


def test_secret_sql_on_random_joined_words(spark):
    """Random runs of names, words, signs and keys reach every allow rule: the SQL tells what the operator tells."""
    import random
    rng = random.Random(11)
    pieces = ["my", "App", "KEY", "secretName", "your", "example", "xxxx", "12345678", "a1", "Zx9Qk2Lm7Vt4Rb8Np1Wc6Yd", "wJ4lrXUtnF3MIbK7MD9N",
              "0f3a9c77d2", "camelCaseWord", "v2", "path", "to"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["_", "-", "/", "=", "==", "__", "--", "+", "", "_"])
                     for _ in range(rng.randrange(2, 9))) + rng.choice(["", "=", " tail"]) for _ in range(900)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.scan_report(df).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(x) for x in enumerate(texts)])
    want = dict(con.execute(f"SELECT doc_id, spans FROM ({secrets.sql()})").fetchall())
    assert [(texts[i], got[i], want[i]) for i in got if got[i] != want[i]] == []
    assert 100 < sum("entropy" in v for v in got.values()) < 800


def test_secret_scan_of_long_runs_and_many_matches(spark):
    """A run of a million characters, and a text of 20,000 matches: time in proportion to their length."""
    import random
    import time
    rng = random.Random(2)
    run = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWabcdefghjkmnpqrstuvw023456789") for _ in range(1_000_000))
    flat = "z1" * 500_000
    many = " ".join(f"{i:016x}" for i in range(20_000))
    df = spark.createDataFrame([(0, f"img {run} end"), (1, flat), (2, many)], "doc_id long, text string").repartition(3)
    secrets.scan_report(df.limit(1)).collect()
    began = time.time()
    got = {r["doc_id"]: r for r in secrets.scan_report(df).collect()}
    assert time.time() - began < 90
    assert got[0]["spans"] == f"entropy:4:{4 + len(run)}" and got[1]["spans"] == ""
    assert got[2]["n_hex"] == 20_000 and got[2]["spans"].endswith(f"hex:{17 * 19_999}:{17 * 20_000 - 1}")


def test_sliding_entropy_equals_brute_force(spark):
    import random
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdef0123456789XYZ+/"[:n]) for _ in range(20 + 7 * n)) for n in range(2, 21)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    from pyspark.sql import functions as F
    for r in df.select("t", secrets.best_entropy(F.col("t")).alias("h")).collect():
        # the operator keeps the window of the highest entropy: the smallest sum of c log2 c
        assert abs(r["h"] - brute_entropy(r["t"])) < 1e-9


def test_secret_odd_rows(spark):
    rows = secrets.scan_report(documents(spark, ODD_TEXTS, clash=("assign", "hex", "spans", "_text"))).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    assert {r["spans"] for r in rows} == {""} and secrets.scan_report(empty(spark)).isEmpty()


ITEM = ("A train leaves Paris at 9 with 120 people and stops in Lyon after 3 hours so that "
        "half of the 120 people leave it before Paris hears of the delay near Lyon")


def template(first, second, n, other=None):
    return (f"Intro words stand here, then: A train leaves {first} at 9 with {n} people and stops in {second} after 3 hours so "
            f"that half of the {other or n} people leave it before {first} hears of the delay near {second} and so on")


def found(spark, texts, items=(ITEM,), clash=()):
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    return decontaminate.matches(documents(spark, texts, clash=clash), bench)


def test_reparameterised_questions_are_caught_only_with_consistent_slots(spark):
    texts = [template("Paris", "Lyon", 120), template("London", "Leeds", 75), template("London", "Leeds", 75, 80),
             "Nothing of the kind is told in this text about people and delays.", ITEM.upper()]
    rows = {r["doc_id"]: r for r in found(spark, texts).collect()}
    assert set(rows) - {None} == {0, 1, 4}
    assert rows[0]["n_changed"] == 0 and rows[1]["n_changed"] >= 4
    bench = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    kept = decontaminate.clean(documents(spark, texts), bench)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 3, None]


def test_decontamination_odd_rows_and_items(spark):
    items = (ITEM, None, "", "short item", "1 2 3 4 5 6 7 8 9 10 11 12 13 14")
    texts = [*ODD_TEXTS, "Short item!", "5 6 7 8 9 1 2 3 4 5 6 7 8 9 10 11"]
    rows = found(spark, texts, items, clash=("item_id", "window", "at", "tokens", "id", "offset", "words")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(len(ODD_TEXTS), 3)}
    assert found(spark, []).isEmpty() or True
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(documents(spark, texts), bench).isEmpty()
    assert decontaminate.matches(empty(spark), spark.createDataFrame([(0, ITEM)], "item_id long, text string")).isEmpty()


def test_shuffled_join_finds_the_same(spark, monkeypatch):
    texts = [template("Paris", "Lyon", 120), template("London", "Leeds", 75)]
    want = sorted(map(str, found(spark, texts).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", -1)
    assert sorted(map(str, found(spark, texts).collect())) == want


def test_short_and_slot_heavy_items_are_found(spark):
    items = ("What is the capital of France?", "Sort 12 7 9 31 5 18 2 44 now", "3 1 4 1 5 9 2 6 5 3", "Add 2 and 3")
    texts = ["The quiz began so: What is the capital of France? Nobody knew it, as ever.",
             "Then came this: Sort 12 7 9 31 5 18 2 44 now and nothing else.",
             "and sort 13 8 10 32 6 19 3 45 now please", "and sort 13 8 10 32 6 19 3 45 later",
             "digits 3 1 4 1 5 9 2 6 5 3 of a number", "digits 4 2 5 2 6 8 3 7 6 4 of a number",
             "You add 7 and 8 first", "No such question stands in this text of many words"]
    got = {(r["doc_id"], r["item_id"]): r for r in found(spark, texts, items).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 1), (4, 2), (6, 3)}
    assert got[0, 0]["start"] == 4 and got[0, 0]["covered"] == got[0, 0]["item_tokens"] == 6
    assert got[1, 1]["n_changed"] == 0 and got[2, 1]["n_changed"] == 8 and got[4, 2]["n_slots"] == 10


def test_near_copies_clashes_and_split_occurrences(spark):
    split = ("One basket holds red apples while young children sing Anna counts every green pear beside them before evening "
             "falls and nobody ever knows what happens later down there today")
    texts = [ITEM.replace("the 120 people", "the 125 people"),            # a copy with one slip
             template("London", "London", 75),                            # two places became one
             "Then one basket holds red apples while young children sing loudly Anna counts every green pear beside them before evening falls.",
             "Then one basket holds red apples while young children sing Mary Ann counts every green pear beside them before evening falls.",
             "Then one basket holds red apples while young children sing. Nobody counts green pear trees."]
    got = {(r["doc_id"], r["item_id"]): r for r in found(spark, texts, (ITEM, split)).collect()}
    assert set(got) == {(0, 0), (2, 1), (3, 1)}
    assert got[0, 0]["n_changed"] == 0 and got[0, 0]["covered"] >= 13
    assert [(got[i, 1]["start"], got[i, 1]["covered"], got[i, 1]["item_tokens"]) for i in (2, 3)] == [(1, 19, 29)] * 2
