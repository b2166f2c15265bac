import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_helpers import ODD_TEXTS, corpus, documents, empty  # noqa: F401
from hypothesis import given, settings, strategies as st

from telemetra.llm import packing, queries


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.vocabulary())


def check(rows, ids_of):
    """Every id in exactly one piece; sequences gapless and full or a power of two."""
    covered = defaultdict(Counter)
    for r in rows:
        ids = ids_of[r["doc_id"]]
        part = ids[r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["doc_tokens"] == len(ids)
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r["ids_crc32"]
        covered[r["doc_id"]].update(range(r["start"], r["start"] + r["length"]))
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.MAX_TOKENS and at & (at - 1) == 0
    return covered


def test_query_round_trip(spark, corpus, reference):
    rows = queries.op5_hilbert_packing(spark, "/root/testdata/sf0.001").collect()
    ids = {r["doc_id"]: reference.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in corpus}
    covered = check(rows, ids)
    assert all(covered[i] == Counter(range(len(x))) for i, x in ids.items())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z9'.\n\t\r\x0b\x85 é中\U0001F600<|>s")), max_size=40))
def test_ids_equal_the_vocabulary_library(text):
    from tokenizers import Tokenizer
    global _full
    _full = globals().get("_full") or Tokenizer.from_file(queries.vocabulary())
    want = _full.encode(text, add_special_tokens=False).ids
    bpe = packing.tokenizer(queries.vocabulary())
    assert np.frombuffer(bpe.encode(text), dtype="<u2").tolist() == want
    assert cut_ids(bpe, [text, "", text])[::2] == [want, want]


def cut_ids(bpe, texts):
    """Ids by the path that a text takes: cut at blanks where it can be."""
    import pyarrow as pa
    hard, out = bpe.needs_whole(pa.array(texts, pa.string())), [None] * len(texts)
    easy = [i for i in range(len(texts)) if not hard[i]]
    if easy:
        ids, ends, sums = bpe.encode_cut(pa.array(["left out", *(texts[i] for i in easy)]).slice(1), packing.directions())
        for i, part, total in zip(easy, np.split(ids, ends[:-1]), sums):
            assert part[-1] == packing.END_ID and np.allclose(total, packing.directions()[part].sum(0, dtype=float), atol=1e-4)
            out[i] = part[:-1].tolist()
    return [np.frombuffer(bpe.encode(t), dtype="<u2").tolist() if out[i] is None else out[i] for i, t in enumerate(texts)]


def test_pieces_in_slices_and_a_full_cache(reference, monkeypatch):
    """Distinct pieces are encoded together, with a cache that keeps overflowing."""
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 50)
    bpe = packing.ByteBpe(queries.vocabulary())
    texts = [" ".join(f"Wörd{(i * j) % 97}x, y{j}" for j in range(60)) for i in range(40)] + ["a\n b \n c", "x  ", " lead", "", "é" * 300]
    for part in (texts, texts[::-1]):
        assert cut_ids(bpe, part) == [reference.encode(t, add_special_tokens=False).ids for t in part]
    assert len(bpe.known) <= 50


def test_neighbours_on_the_curve_share_sequences(spark):
    """Texts of one kind are packed together: sequences hold far fewer kinds than by chance."""
    kinds = [[f"{w}{k}" for w in ("stone", "river", "cloud", "ember", "metal")] for k in ("a", "zz", "9", "É")]
    rows = [(i, " ".join(kinds[i % 4][j % 5] for j in range(60))) for i in range(400)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), queries.vocabulary()).collect()
    held = defaultdict(set)
    for r in got:
        held[r["sequence_id"]].add(r["doc_id"] % 4)
    assert np.mean([len(v) for v in held.values()]) < 2


def test_special_token_text(reference):
    text = "a <|endoftext|> b"
    got = np.frombuffer(packing.tokenizer(queries.vocabulary()).encode(text), dtype="<u2").tolist()
    assert got == reference.encode(text, add_special_tokens=False).ids


def test_hilbert_curve_visits_every_cell_by_neighbours():
    bits = 3
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert_key(grid, bits)
    assert sorted(key.tolist()) == list(range(8 ** 3))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_binary_tail():
    assert packing.binary_lengths(1300) == [1024, 256, 16, 4] and packing.binary_lengths(0) == []


def test_odd_rows(spark, reference):
    clash = ("id", "key", "tie", "ids", "start", "length", "offset", "sequence_id")
    rows = packing.pack(documents(spark, ODD_TEXTS, clash=clash), queries.vocabulary()).collect()
    ids = {i: reference.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(ODD_TEXTS)}
    ids[None] = reference.encode("no id here", add_special_tokens=False).ids + [1]
    covered = check(rows, ids)
    for i, x in ids.items():                    # the last row is there twice
        assert covered[i] == Counter({k: 2 if i == len(ODD_TEXTS) - 1 else 1 for k in range(len(x))})
    assert covered[0] == Counter({0: 1})
    assert packing.pack(empty(spark), queries.vocabulary()).isEmpty()
