"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Texts become sequences of canonical tokens: words are lower-cased and stripped of outer
punctuation; numbers, units and names are replaced by the typed placeholders ``<num>``,
``<unit>`` and ``<name>``, and their own text is kept as the slot's value. Windows of
``WINDOW`` canonical tokens of the benchmark are hash-joined with those of the documents.

Windows that match at one offset (document position less benchmark position) belong to one
occurrence. Its **slots must be consistent**: a value of the benchmark always became the
same value in the document and the other way round. So a question with other numbers and
names is caught, while unrelated text of the same template, in which equal slots became
different ones or different ones equal, is not; of an inconsistent occurrence only the
windows without a changed value count, so a copy with one slip is caught. An occurrence counts when its matching windows cover at least
``MIN_TOKENS`` benchmark tokens or ``MIN_COVER`` of the item. A window of which under
``MIN_PLAIN`` are plain words counts where its values equal the benchmark's, or where the
item is covered as a whole and has a plain word. Text without any plain word (counting,
rows of a table) must be the whole item, value by value.

An inserted or missing word, or a name of two words for one of one, splits an occurrence
over neighbouring offsets (up to ``SHIFT`` apart). Parts too small to count alone count
together, as one row, when what they cover adds up and their numbers and units agree; names
may differ from part to part, as the word at a split does.

Names are capitalised words that don't begin a sentence, i.e. don't follow the text's start
or end-of-sentence punctuation; a capitalised word elsewhere is a plain word.

Plan: documents are reduced to arrays of token hashes in one pass. The windows of the
benchmark are few; up to ``BROADCAST_WINDOWS`` of them (counted first) are broadcast and
document windows never leave their task unless they match. Beyond, the join is shuffled;
window hashes that a large share of the documents hold are spread by the join's own skew
handling. Only documents that match are read a second time for their slots.

Null texts have no tokens and match nothing. Items of fewer than ``WINDOW`` tokens match as
a whole sequence anywhere in a document: windows of each such length that the benchmark has
(seven at most) are made too. Repeated rows and items are matched one by one. An empty table gives an
empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.llm.common import broadcast_if_small, cut, packed

WINDOW = 8
MIN_TOKENS = 13
MIN_COVER = 0.5
MIN_PLAIN = 0.5
SHIFT = 3
BROADCAST_WINDOWS = 500_000

# fixed values: units of measure that follow a number
UNITS = ("mm cm m km in ft yd mi mg g kg lb oz ml l s sec min h hr day days week weeks month months year years hours "
         "minutes seconds meters metres kilometers kilometres miles feet inches grams kilograms pounds liters litres "
         "dollars euros cents usd eur percent degrees").split()
NUM, UNIT, NAME = "<num>", "<unit>", "<name>"
OUTER = r"^[^\p{L}\p{N}$+-]+|[^\p{L}\p{N}%]+$"
NUMBER = r"^[+-]?[$]?[0-9][0-9.,:/]*(st|nd|rd|th|%)?$"
SENTENCE_END = r"[.!?:;|\"')\]]$"


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    """White-space separated words; blanks alone make none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def _bare(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, OUTER, ""))


def _token(raw: Column, word: Column, i: Column) -> Column:
    """Canonical token of one word; empty for a word without letter or digit."""
    before = F.get(raw, i - 1)
    after_digit = F.coalesce(F.substring(before, -1, 1).between("0", "9"), F.lit(False))
    bare, units = F.regexp_replace(word, OUTER, ""), F.array(*[F.lit(u) for u in UNITS])
    return (F.when(word.rlike(r"^\p{Ll}+$") & ~after_digit, word)     # most words: nothing else applies
            .when(bare == "", F.lit(""))
            .when(bare.rlike(NUMBER), F.lit(NUM))
            .when(after_digit & F.array_contains(units, F.lower(bare)), F.lit(UNIT))
            .when((i > 0) & bare.rlike(r"^\p{Lu}\p{Ll}") & ~before.rlike(SENTENCE_END), F.lit(NAME))
            .otherwise(F.lower(bare)))


def canonical(text: Column) -> Column:
    """Array of canonical tokens of a text."""
    return _let(_words(text), lambda raw: F.filter(
        F.transform(raw, lambda w, i: _token(raw, w, i)), lambda c: c != ""))


def slots(text: Column) -> Column:
    """Array of (c, v): canonical tokens with the words they stand for, aligned with ``canonical``."""
    return _let(_words(text), lambda raw: F.filter(
        F.transform(raw, lambda w, i: F.struct(_token(raw, w, i).alias("c"), _bare(w).alias("v"))), lambda x: x["c"] != ""))


def window_hashes(tokens: Column, width: int = WINDOW) -> Column:
    """Hash of every window of ``width`` tokens; of the whole sequence where it is shorter."""
    def of(h: Column) -> Column:
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                .when(F.size(h) <= width, F.array(F.xxhash64(h)))
                .otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - width),
                                       lambda i: F.xxhash64(F.array(*[F.get(h, i + j) for j in range(width)])))))
    return _let(F.transform(tokens, lambda c: F.xxhash64(c)), of)


def _placed_hashes(tokens: Column, short: list[int]) -> Column:
    """Array of (at, window): every window of ``WINDOW`` tokens and of the ``short`` widths."""
    def of(t: Column) -> Column:
        return F.concat(*[F.transform(window_hashes(t, w), lambda x, i: F.struct(i.alias("at"), x.alias("window")))
                          for w in (WINDOW, *short)])
    return _let(tokens, of)


def _is_plain(token: Column) -> Column:
    return ~token["c"].isin(NUM, UNIT, NAME)


def _plain_share(items: Column, at: Column, width: int) -> Column:
    part = F.slice(items, at + 1, F.lit(width))
    return F.size(F.filter(part, _is_plain)) / F.size(part)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
            item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per contaminated occurrence.

    (id, text_hash, item_id, start, item_start, covered, item_tokens, n_slots, n_changed):
    token positions where the occurrence begins, benchmark tokens covered, slots among them
    and those with another value than the benchmark's.
    """
    items = cut(benchmark.select(F.col(item_col).alias("item_id"), slots(F.col(item_text)).alias("tokens"))
                .filter(F.size("tokens") > 0)
                .withColumn("item_row", F.monotonically_increasing_id()), "benchmark")
    grams = items.select("item_row", F.posexplode(window_hashes(F.col("tokens.c"))).alias("item_at", "window"))
    short = sorted(r[0] for r in items.select(F.size("tokens")).filter(F.size("tokens") < WINDOW).distinct().collect())
    doc = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    tokens = canonical(F.col("text"))
    seen = doc.select("id", "text_hash", F.inline(_placed_hashes(tokens, short)) if short else
                      F.posexplode(window_hashes(tokens)).alias("at", "window"))
    hits = seen.join(broadcast_if_small(grams, BROADCAST_WINDOWS), "window")
    found = cut(hits.groupBy("id", "text_hash", "item_row", (F.col("at") - F.col("item_at")).alias("offset"))
                .agg(F.sort_array(F.collect_set("item_at")).alias("ats")), "benchmark-hits")
    wanted = broadcast_if_small(found.select("id", "text_hash").distinct())
    texts = doc.join(wanted, doc.id.eqNullSafe(wanted.id) & (doc.text_hash == wanted.text_hash), "left_semi") \
        .dropDuplicates(["id", "text_hash"]).select(
            F.col("id").alias("d"), F.col("text_hash").alias("dh"), slots(F.col("text")).alias("words"))
    n = F.size("tokens")
    width = F.least(F.lit(WINDOW), n)

    def under(ats: str) -> Column:
        """Benchmark positions under these windows, each once."""
        return F.array_distinct(F.flatten(F.transform(ats, lambda a: F.sequence(a, a + width - 1))))

    def values(p: Column) -> tuple[Column, Column]:
        return F.get(F.col("tokens"), p)["v"], F.get(F.col("words"), p + F.col("offset"))["v"]

    def pairs(positions: str) -> Column:
        return F.transform(F.filter(positions, lambda p: ~_is_plain(F.get(F.col("tokens"), p))),
                           lambda p: F.struct(values(p)[0].alias("was"), values(p)[1].alias("now")))

    joined = found.join(items, "item_row").join(texts, found.id.eqNullSafe(texts.d) & (found.text_hash == texts.dh)) \
        .withColumn("all_under", under("ats")).withColumn("all_pairs", pairs("all_under"))
    def consistent(x: str) -> Column:
        return (F.size(F.array_distinct(x)) == F.size(F.array_distinct(F.col(x)["was"]))) \
            & (F.size(F.array_distinct(x)) == F.size(F.array_distinct(F.col(x)["now"])))

    equal = lambda a: F.forall(F.sequence(a, a + width - 1), lambda p: values(p)[0] == values(p)[1])
    whole = (F.size("all_under") == n) & F.exists("tokens", _is_plain)
    named = lambda p: F.get(F.col("tokens"), p)["c"] == NAME
    parts = joined.withColumn("equal_ats", F.filter("ats", equal)) \
        .withColumn("ats", F.when(consistent("all_pairs"), F.filter("ats", lambda a: (
            (_plain_share(F.col("tokens"), a, WINDOW) >= MIN_PLAIN) | F.array_contains("equal_ats", a) | whole)))
            .otherwise(F.col("equal_ats"))) \
        .filter(F.size("ats") > 0).withColumn("under", under("ats")).withColumn("equal_under", under("equal_ats")) \
        .withColumn("counted", F.filter("under", lambda p: ~named(p))).withColumn("counted", pairs("counted")) \
        .select("id", "text_hash", "item_row", "item_id", "offset", n.alias("n"), "under", "equal_under", "counted",
                pairs("under").alias("pairs"), F.transform("tokens", _is_plain).alias("plain"))

    def counts(positions: str) -> Column:
        """Whether what is covered is enough of the item, and no mere run of slots."""
        size = F.size(positions)
        told = (size == F.col("n")) | F.exists(positions, lambda p: F.get(F.col("plain"), p))
        return told & ((size >= MIN_TOKENS) | (size >= F.col("n") * MIN_COVER))

    def row(positions: str, start: Column, slot_pairs: str) -> list[Column]:
        return [F.col("id").alias(id_col), "text_hash", "item_id", start.alias("start"),
                F.array_min(positions).alias("item_start"), F.size(positions).alias("covered"), F.col("n").alias("item_tokens"),
                F.size(slot_pairs).alias("n_slots"),
                F.size(F.filter(slot_pairs, lambda x: x["was"] != x["now"])).alias("n_changed")]

    parts = cut(parts.withColumn("alone", counts("under")), "benchmark-parts")
    alone = parts.filter("alone").select(*row("under", F.col("offset") + F.array_min("under"), "pairs"))
    # parts of one item at neighbouring offsets, none of which counts alone
    key = ["id", "text_hash", "item_row"]
    by_offset = Window.partitionBy(*key).orderBy("offset")
    apart = F.coalesce(F.col("offset") - F.lag("offset").over(by_offset) > SHIFT, F.lit(True))
    chains = parts.withColumn("apart", apart.cast("int")).withColumn("chain", F.sum("apart").over(by_offset)) \
        .groupBy(*key, "chain").agg(
            F.max("alone").alias("alone"), F.count("*").alias("n_parts"), F.first("item_id").alias("item_id"),
            F.first("n").alias("n"), F.first("plain").alias("plain"),
            *[F.flatten(F.collect_list(x)).alias(x) for x in ("counted", "pairs")],
            *[F.array_distinct(F.flatten(F.collect_list(x))).alias(x) for x in ("under", "equal_under")],
            F.min(F.col("offset") + F.array_min("under")).alias("start"),
            F.min(F.col("offset") + F.array_min("equal_under")).alias("equal_start"))
    joint = chains.filter(~F.col("alone") & (F.col("n_parts") > 1)).withColumn("agreed", consistent("counted")) \
        .withColumn("pairs", F.when(F.col("agreed"), F.array_distinct("pairs")).otherwise(
            F.array_distinct(F.filter("pairs", lambda x: x["was"] == x["now"])))) \
        .withColumn("start", F.when(F.col("agreed"), F.col("start")).otherwise(F.col("equal_start"))) \
        .withColumn("under", F.when(F.col("agreed"), F.col("under")).otherwise(F.col("equal_under"))) \
        .filter(counts("under")).select(*row("under", F.col("start"), "pairs"))
    return alone.unionByName(joint)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    bad = cut(matches(docs, benchmark, id_col, text)
              .select(F.col(id_col).alias("id"), "text_hash").distinct(), "benchmark-bad")
    rows = docs.select(packed(docs), docs[id_col].alias("i"), F.xxhash64(text).alias("h"))
    return rows.join(broadcast_if_small(bad), F.expr("i <=> id AND h = text_hash"), "left_anti").select("row.*")


def _sql_tokens(source: str, key: str) -> str:
    """DuckDB: one row per token (key, text, pos, c, v) of ``source`` (key, text)."""
    outer = OUTER.replace("'", "''")
    return f"""
    SELECT {key}, text, row_number() OVER (PARTITION BY {key}, text ORDER BY i) - 1 AS pos, c, v FROM (
      SELECT *, CASE WHEN bare = '' THEN ''
        WHEN regexp_matches(bare, '{NUMBER}') THEN '{NUM}'
        WHEN regexp_matches(before, '[0-9]$') AND list_contains({UNITS}, v) THEN '{UNIT}'
        WHEN i > 1 AND regexp_matches(bare, '^\\p{{Lu}}\\p{{Ll}}') AND NOT regexp_matches(before, '{SENTENCE_END.replace("'", "''")}')
        THEN '{NAME}' ELSE v END AS c
      FROM (SELECT {key}, text, i, w, ws[i - 1] AS before, regexp_replace(w, '{outer}', '', 'g') AS bare,
                   lower(regexp_replace(w, '{outer}', '', 'g')) AS v
            FROM (SELECT {key}, text, ws, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
                  FROM (SELECT {key}, text, list_filter(string_split(regexp_replace(text, '[\\t\\n\\x0b\\x0c\\r]', ' ', 'g'), ' '),
                                                     lambda x: x <> '') AS ws
                        FROM (SELECT DISTINCT {key}, text FROM {source} WHERE text IS NOT NULL)))))
    WHERE c <> ''"""


def sql() -> str:
    """DuckDB SQL for the rows of op3_decontaminate."""
    kinds = f"('{NUM}', '{UNIT}', '{NAME}')"
    grams = """
    SELECT {key}, text, i - 1 AS at, cs[i:i + {w} - 1] AS cs, array_to_string(cs[i:i + {w} - 1], ' ') AS win
    FROM (SELECT {key}, text, cs, unnest(generate_series(1, greatest(1, len(cs) - {w} + 1))) AS i
          FROM (SELECT {key}, text, list(c ORDER BY pos) AS cs FROM {src} GROUP BY {key}, text))"""
    return f"""
WITH dt AS MATERIALIZED ({_sql_tokens('documents', 'doc_id')}),
bt AS MATERIALIZED ({_sql_tokens('benchmark', 'item_id')}),
bn AS (SELECT item_id, count(*) AS n FROM bt GROUP BY item_id),
dg AS ({grams.format(key='doc_id', w=WINDOW, src='dt')}),
bg AS (SELECT * FROM ({grams.format(key='item_id', w=WINDOW, src='bt')})
       WHERE len(list_filter(cs, lambda x: x NOT IN {kinds})) >= len(cs) * {MIN_PLAIN}),
hits AS (SELECT DISTINCT d.doc_id, d.text, b.item_id, d.at - b.at AS shift, b.at AS item_at
         FROM dg d JOIN bg b ON d.win = b.win),
under AS (SELECT DISTINCT doc_id, text, item_id, shift, unnest(generate_series(item_at, item_at + least({WINDOW}, n) - 1)) AS p
          FROM hits JOIN bn USING (item_id)),
pairs AS (SELECT u.doc_id, u.item_id, u.text, u.shift, u.p, b.c IN {kinds} AS slot, b.v AS was, d.v AS now
          FROM under u JOIN bt b ON b.item_id = u.item_id AND b.pos = u.p
          JOIN dt d ON d.doc_id = u.doc_id AND d.text = u.text AND d.pos = u.p + u.shift)
SELECT doc_id, item_id, (shift + min(p))::INTEGER AS start, min(p)::INTEGER AS item_start, count(*)::INTEGER AS covered,
       any_value(n)::INTEGER AS item_tokens, (count(*) FILTER (WHERE slot))::INTEGER AS n_slots,
       (count(*) FILTER (WHERE slot AND was <> now))::INTEGER AS n_changed
FROM pairs JOIN bn USING (item_id)
GROUP BY doc_id, item_id, text, shift
HAVING count(DISTINCT CASE WHEN slot THEN [was, now] END) = count(DISTINCT CASE WHEN slot THEN was END)
   AND (count(*) >= {MIN_TOKENS} OR count(*) >= any_value(n) * {MIN_COVER})
"""
