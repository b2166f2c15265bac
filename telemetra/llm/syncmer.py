"""Document fingerprints from closed syncmers, with DataFrame functions only.

A text is a sequence of tokens: runs of letters, of digits and of signs, and single
characters of scripts that are written without blanks; a cut depends on the two characters
beside it alone. Tokens are hashed to 64 bits, and the sequence is led and followed by
``K`` - 1 marks that hash lower than any token. A k-mer is ``K`` tokens in a row; it is a
**closed syncmer** when the smallest hash among its inner substrings of ``S`` tokens is that
of its first or its last one. Whether a k-mer is chosen depends on the k-mer alone, so the
same passage yields the same anchors in any text (no context), and of any K - S + 1
neighbouring k-mers one at least is chosen. K-mers that hold marks are always chosen: the
first and last tokens of a text are anchors of it, so a text of any length has some.

The fingerprint lists the anchors' 32-bit hashes in text order, as hex. A text without
tokens has none. Likeness of two fingerprints is the Jaccard index of their anchors; two
empty ones are alike (1.0), an empty and a non-empty one are not (0.0).

``anchors`` gives (position, 64-bit hash) pairs, positions in tokens, and
``match_positions`` joins two tables of them on the hash, grouped by offset, for positional
matching.

Null text counts as empty. Ids may be of any type that has an order; equal ids follow each
other by text, and null ids come first. All work is per row, linear in the text; the
shuffles are those of ``with_next``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from telemetra.llm.common import cut
from telemetra.llm.merkle import ranked

K = 5
S = 1
#: scripts whose words follow each other without blanks: every character is a token
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
TOKEN = rf"[{UNSPACED}]|[\p{{L}}\p{{M}}&&[^{UNSPACED}]]+|\p{{N}}+|[^\s\p{{L}}\p{{M}}\p{{N}}]+"
MARK = -(1 << 63)   # below (or equal to) every hash
BLOCK = 64          # consecutive ids linked in one window partition
PREFIX = 24         # characters of the text that tell blocks of null ids apart


def token_hashes(text: Column) -> Column:
    """Array of 64-bit token hashes."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row."""
    return F.transform(F.array(value), use)[0]


def _anchors(text: Column, k: int, s: int, positions: bool) -> Column:
    """Anchor hashes of a text with its marks; with ``positions``, (position, hash) of k-mers without marks."""
    last = k - s      # index of the last inner substring of a k-mer

    def inner_of(h: Column) -> Column:
        return F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (s - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, s)]))

    def chosen(h: Column, g: Column) -> Column:
        tokens = lambda i: [F.get(h, i + j) for j in range(k)]
        closed = F.filter(F.sequence(F.lit(0), F.size(h) - k), lambda i: (
            (F.get(h, i) == MARK) | (F.get(h, i + (k - 1)) == MARK)
            | (F.least(*[F.get(g, i + j) for j in range(1, last)]) >= F.least(F.get(g, i), F.get(g, i + last)))))
        code = (lambda i: F.struct(i.alias("position"), F.xxhash64(*tokens(i)).alias("hash"))) if positions else (lambda i: F.hash(*tokens(i)))
        return F.transform(closed, code)

    none = F.array().cast("array<struct<position:int,hash:bigint>>" if positions else "array<int>")
    marks = F.array_repeat(F.lit(MARK), k - 1)
    led = token_hashes(text) if positions else _let(
        token_hashes(text), lambda h: F.when(F.size(h) > 0, F.concat(marks, h, marks)).otherwise(h))
    return _let(led, lambda h: F.when(F.size(h) >= k, chosen(h, h) if s == 1 else _let(inner_of(h), lambda g: chosen(h, g))).otherwise(none))


def anchors(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """One row per anchor without marks: id, token position, hash."""
    return docs.select(F.col(id_col), F.explode(_anchors(F.col(text), k, s, True)).alias("a")).select(id_col, "a.*")


def match_positions(left: DataFrame, right: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Anchors that two anchor tables share, counted by pair of texts and offset.

    ``offset`` is the right position less the left one: one long passage in common shows as
    one offset with many matches.
    """
    a = left.select(F.col(id_col).alias("left_id"), F.col("position").alias("p"), "hash")
    b = right.select(F.col(id_col).alias("right_id"), F.col("position").alias("q"), "hash")
    return a.join(b, "hash").groupBy("left_id", "right_id", (F.col("q") - F.col("p")).alias("offset")) \
        .agg(F.count("*").alias("matches"))


def to_hex(codes: Column) -> Column:
    return F.concat_ws("", F.transform(codes, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two anchor arrays."""
    together = F.size(F.array_union(a, b))
    return F.when(together == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / together)


def with_next(docs: DataFrame, id_col: str, text: str, derive: Callable[[Column], Column]) -> DataFrame:
    """(id, text, own, next, next_own): each row with the text of the next higher id.

    ``own`` and ``next_own`` are ``derive`` of the two texts, computed once per row after the
    shuffle. The last row gets the first. Rows are cut into blocks in their order: of ``BLOCK``
    consecutive values for whole numbers, of one id for other types, of texts with one
    ``PREFIX`` for null ids; each is a window partition. The row after a block's last one is the
    first of the next block: blocks are numbered by a range sort (``merkle.ranked``) of their
    keys alone, and joined with the first texts by number. No task sees more than a few
    blocks, whatever the ids' spread.
    """
    whole = isinstance(docs.schema[id_col].dataType, IntegralType)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    coarse = F.floor(F.col("id") / BLOCK).cast("long") if whole else F.col("id")
    order = {"known": F.col("id").isNotNull(), "value": coarse,
             "prefix": F.coalesce(F.when(F.col("id").isNull(), F.substring("text", 1, PREFIX)), F.lit(""))}
    # a block's name: one plain column to partition and join by, so that linked rows stay where they are
    rows = rows.withColumns(order).withColumn("block", F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]))
    firsts = cut(rows.groupBy("block", *order).agg(F.min_by("text", F.struct("id", "text")).alias("first")), "syncmer-blocks")
    w = Window.partitionBy("block").orderBy("id", "text")
    linked = rows.drop(*order).repartition("block").withColumn("own", derive(F.col("text"))) \
        .withColumn("next", F.lead("text").over(w)).withColumn("next_own", F.lead("own").over(w))
    numbered = cut(ranked(firsts.select(F.lit("").alias("tree"), "block", *order), list(order), "syncmer-order"), "syncmer-numbers")
    follower = numbered.select(F.pmod(F.col("lo") - 1, F.col("n")).alias("lo"), F.col("block").alias("follower"))
    after = numbered.select("block", "lo").join(follower, "lo").join(
        firsts.select(F.col("block").alias("follower"), F.col("first").alias("after")), "follower")
    return linked.join(after.select("block", "after"), "block").select(
        "id", "text", "own", F.coalesce("next", "after").alias("next"),
        F.when(F.col("next").isNull(), derive(F.col("after"))).otherwise(F.col("next_own")).alias("next_own"))


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    The edited text replaces the last quarter of the code points by the first as many of the
    next text.
    """
    make = lambda c: _anchors(c, k, s, False)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next"), F.lit(1), quarter))
    rows = with_next(docs, id_col, text, make).withColumn("edited", edited).withColumn("edited_own", make(F.col("edited")))
    return rows.select(
        F.col("id").alias(id_col), n.cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        to_hex(F.col("own")).alias("fingerprint"), to_hex(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))
