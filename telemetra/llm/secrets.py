"""Secret scan, with DataFrame functions only.

**Base kinds** (regular expressions, leftmost and non-overlapping per kind, then a length
test): ``assign`` (a credential name, a separator, a value), ``access`` (an access key id)
and ``hex`` (a long run of hex digits).

**entropy** (the method): candidate strings are maximal runs of key characters that hold a
digit and a letter. Each has a character class (hex digits, letters and digits, Base64
signs). A window of ``WINDOW`` characters slides over the candidate; its Shannon entropy is
kept up to date by the counts of the one character that enters and the one that leaves:
with S the sum of c log2 c over the characters in the window, H = log2 W - S / W. A
candidate is a secret when its best window reaches the threshold of its class. A candidate
that an allow rule hits (identifiers, placeholders, alphabet runs, words joined by signs) is
taken apart: at ``=`` into names and values (trailing padding stays with its value), and
around joined words; it is a secret when one of these parts reaches the threshold of its
class and is no placeholder. Candidates that overlap a base span are left to it.

Positions are code points, end exclusive. A pattern is applied as ``\\G(.*?)(pattern)``:
the matches and the gaps between them come out in text order, and their lengths add up to
positions, in one linear pass a kind. Null text counts as empty. Work is per row; there is
no shuffle. Repeated rows, null ids and further columns don't matter to it.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: patterns of the base kinds, smallest lengths (of group 2 for assign)
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: bits a character that the best window must reach, by character class
THRESHOLDS = {"hex": 3.0, "alnum": 3.55, "base64": 3.7}
#: values that are no secrets, wherever the hit lies
NO_VALUE = (r"(?i)example|placeholder|changeme|your[_-]|xxxx|abcdefgh|01234567|12345678"
            r"|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
#: candidates that are judged by their parts
BY_PARTS = NO_VALUE + r"|(?:[a-z]{2,}[_/-]){3}|__|--"
#: words joined by signs; a word keeps to one case or to capitals inside, which random letters rarely do
_WORD = r"(?:[A-Z]?[a-z]{2,}(?:[A-Z][a-z]+)*|[A-Z]{2,})"
JOINED_WORDS = rf"(?:(?<![A-Za-z0-9+]){_WORD}[_/-]+(?:{_WORD}[_/-]+){{2,}}{_WORD}?)|(?:(?<![A-Za-z0-9+]){_WORD}(?:__|--){_WORD})"


def _pieces(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?s)\G(.*?)(%s)" % pattern), F.lit(group))


def _span(kind: int, start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))


SPAN = "struct<start:int,kind:int,end:int>"
#: matches whose spans are gathered in one array before it is put away; bounds what an appended span copies
SPANS_AT_ONCE = 256


def spans_of(text: Column, pattern: str, kind: int, ok=None) -> Column:
    """Array of (start, kind, end): all matches of ``pattern`` in text order."""
    zipped = F.arrays_zip(_pieces(text, pattern, 1).alias("gap"), _pieces(text, pattern, 2).alias("hit"))
    none = F.array().cast(f"array<{SPAN}>")

    def one(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.array(_span(kind, start, end))
        return F.struct(end.alias("at"), F.concat(a["spans"], span if ok is None else F.when(ok(x["hit"]), span).otherwise(none)).alias("spans"),
                        a["done"].alias("done"))

    def block(found: Column):
        # a block's matches, then the block itself is put away
        return lambda a, b: F.aggregate(
            F.slice(found, b * SPANS_AT_ONCE + 1, SPANS_AT_ONCE),
            F.struct(a["at"].alias("at"), none.alias("spans"), a["done"].alias("done")), one,
            lambda z: F.struct(z["at"].alias("at"), F.concat(z["done"], F.array(z["spans"])).alias("done")))

    def walked(found: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / SPANS_AT_ONCE).cast("int"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("done"))
        return F.when(F.size(found) > 0, F.aggregate(blocks, start, block(found), lambda a: F.flatten(a["done"]))).otherwise(none)
    # the matches are found once: a one-element array carries them into the walk
    return F.transform(F.array(zipped), walked)[0]


def _clog(n: int) -> float:
    """n log2 n, 0 at 0."""
    return n * math.log2(n) if n else 0.0


def best_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy (bits a character) of a window sliding over ``candidate``.

    Needs a candidate of at least ``window`` characters. The window's own characters travel
    along, so a step costs the same wherever it is in the candidate.
    """
    # what the sum of c log2 c grows by when a count goes from n to n + 1
    growth = F.array(*[F.lit(_clog(n + 1) - _clog(n)) for n in range(window + 1)])

    def count(where: Column, c: Column) -> Column:
        return F.length(where) - F.length(F.replace(where, c, F.lit("")))

    # the first window fills up one character at a time, later ones also lose one
    def step(a: Column, entering: Column) -> Column:
        held, full = a["held"], F.length(a["held"]) == window
        left = F.when(full, F.substring(held, 2, window - 1)).otherwise(held)
        lost = F.when(full, F.get(growth, count(held, F.substring(held, 1, 1)) - 1)).otherwise(F.lit(0.0))
        s = a["s"] + F.get(growth, count(left, entering)) - lost
        return F.struct(s.alias("s"), F.when(F.length(held) >= window - 1, F.least(a["least"], s)).otherwise(a["least"]).alias("least"),
                        F.concat(left, entering).alias("held"))

    return F.aggregate(
        F.split(candidate, ""),
        F.struct(F.lit(0.0).alias("s"), F.lit(1e9).alias("least"), F.lit("").alias("held")), step,
        lambda a: F.lit(math.log2(window)) - a["least"] / window)


def _parts(candidate: Column) -> Column:
    """What is judged of a candidate: itself, or the parts of one that an allow rule hits."""
    values = F.filter(F.split(candidate, "=(?=[^=])"), lambda v: ~v.rlike(NO_VALUE))
    parts = F.flatten(F.transform(values, lambda v: F.split(v, JOINED_WORDS)))
    return F.when(candidate.rlike(BY_PARTS), F.filter(parts, lambda v: F.length(v) >= WINDOW)).otherwise(F.array(candidate))


def is_secret(candidate: Column) -> Column:
    """The entropy rule for one candidate string."""
    def judged(part: Column) -> Column:
        mixed = part.rlike("[0-9]") & part.rlike("[A-Za-z]")
        threshold = (F.when(part.rlike("^[0-9a-fA-F]+$"), THRESHOLDS["hex"])
                     .when(part.rlike("^[A-Za-z0-9]+$"), THRESHOLDS["alnum"]).otherwise(THRESHOLDS["base64"]))
        return F.when(mixed, best_entropy(part) >= threshold).otherwise(F.lit(False))
    return F.exists(_parts(candidate), judged)


def render(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, assign, access, hex, entropy): arrays of (start, kind, end) per row."""
    t = F.coalesce(F.col(text), F.lit(""))
    # a row without the sign that every match needs skips the pattern
    none = F.array().cast(f"array<{SPAN}>")
    base = docs.select(
        F.col(id_col), t.alias("_text"),
        F.when(t.rlike(r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"),
               spans_of(t, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, "(?s)^" + ASSIGN, 2)) >= MIN_ASSIGN))
        .otherwise(none).alias("assign"),
        F.when(F.contains(t, F.lit("AKIA")), spans_of(t, ACCESS, 1, lambda m: F.length(m) >= MIN_ACCESS))
        .otherwise(none).alias("access"),
        F.when(t.rlike(HEX), spans_of(t, HEX, 2)).otherwise(none).alias("hex"))
    found = F.when(F.col("_text").rlike(CANDIDATE), spans_of(F.col("_text"), CANDIDATE, 3, is_secret)).otherwise(none)
    known = F.concat("assign", "access", "hex")
    return base.withColumn("entropy", F.filter(found, lambda s: ~F.exists(
        known, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))).drop("_text")


def scan_report(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans as text."""
    size = lambda c: F.size(c).cast("long")
    base = F.concat("assign", "access", "hex")
    return scan(docs, text, id_col).select(
        id_col, size("assign").alias("n_assign"), size("access").alias("n_access"), size("hex").alias("n_hex"),
        size("entropy").alias("n_entropy"), F.sha2(render(base), 256).alias("base_sha256"),
        render(F.concat(base, F.col("entropy"))).alias("spans"))


def sql() -> str:
    """DuckDB SQL for the rows of op2_secret_scan: matches and the gaps between them give positions;
    a window's entropy is computed from its own characters. The patterns' look-around is written
    as groups that are put back, which RE2 has."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    patterns = [ASSIGN, ACCESS, HEX, CANDIDATE]
    found = " UNION ALL ".join(
        f"SELECT rid, {k} AS kind, regexp_extract_all(t, {quoted(p)}) AS hits, string_split_regex(t, {quoted(p)}) AS gaps FROM d"
        for k, p in enumerate(patterns))
    entropy = (f"list_max(list_transform(range(0, len(part) - {WINDOW} + 1), lambda j: list_sum(list_transform("
               f"list_distinct(string_split(substr(part, j + 1, {WINDOW}), '')), lambda c: "
               f"-(({WINDOW} - len(replace(substr(part, j + 1, {WINDOW}), c, ''))) / {WINDOW}.0) * "
               f"log2(({WINDOW} - len(replace(substr(part, j + 1, {WINDOW}), c, ''))) / {WINDOW}.0)))))")
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    listed = f"string_agg({names}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind, e)"
    words = (rf"(^|[^A-Za-z0-9+])(?:{_WORD}[_/-]+(?:{_WORD}[_/-]+){{2,}}{_WORD}?|{_WORD}(?:__|--){_WORD})")
    parts = (f"flatten(list_transform(list_filter(string_split(regexp_replace(hit, '=([^=])', chr(1) || '\\1', 'g'), chr(1)), "
             f"lambda v: NOT regexp_matches(v, {quoted(NO_VALUE)})), "
             f"lambda v: string_split(regexp_replace(v, {quoted(words)}, '\\1' || chr(1), 'g'), chr(1))))")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
placed AS (SELECT rid, kind, hits[i] AS hit,
              (list_sum(list_transform(gaps[1:i], lambda x: len(x))) +
               coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: len(x))), 0))::BIGINT AS s
       FROM (SELECT *, unnest(generate_series(1, len(hits))) AS i FROM found WHERE len(hits) > 0)),
spans AS (SELECT rid, kind, hit, s, s + len(hit) AS e FROM placed),
base AS (SELECT * FROM spans WHERE (kind = 0 AND len(regexp_extract(hit, {quoted(ASSIGN)}, 2)) >= {MIN_ASSIGN})
                                OR (kind = 1 AND len(hit) >= {MIN_ACCESS}) OR kind = 2),
candidates AS (SELECT * FROM spans c WHERE kind = 3
               AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = c.rid AND b.s < c.e AND c.s < b.e)),
parts AS (SELECT rid, kind, hit, s, e, unnest(CASE WHEN regexp_matches(hit, {quoted(BY_PARTS)})
                 THEN list_filter({parts}, lambda v: len(v) >= {WINDOW}) ELSE [hit] END) AS part FROM candidates),
secrets AS (SELECT DISTINCT rid, kind, hit, s, e FROM parts
            WHERE regexp_matches(part, '[0-9]') AND regexp_matches(part, '[A-Za-z]') AND {entropy} >=
            CASE WHEN regexp_matches(part, '^[0-9a-fA-F]+$') THEN {THRESHOLDS['hex']}
                 WHEN regexp_matches(part, '^[A-Za-z0-9]+$') THEN {THRESHOLDS['alnum']} ELSE {THRESHOLDS['base64']} END),
every AS (SELECT * FROM base UNION ALL SELECT * FROM secrets),
told AS (SELECT rid, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS k,
                count(*) FILTER (WHERE kind = 2) AS h, count(*) FILTER (WHERE kind = 3) AS n,
                {listed.replace("ORDER BY s, kind, e)", "ORDER BY s, kind, e) FILTER (WHERE kind < 3)")} AS b, {listed} AS every_one
         FROM every GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       coalesce(n, 0)::BIGINT AS n_entropy, sha256(coalesce(b, '')) AS base_sha256, coalesce(every_one, '') AS spans
FROM d LEFT JOIN told USING (rid)
"""
