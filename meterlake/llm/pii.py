"""Personal data by bootstrapped contextual extraction, in SQL functions only.

Base entities (email, ip, card, phone) are found by fixed patterns.  They are
the seeds: the two words before a token with digits or ``@`` are its lexical
pattern, and patterns and the tokens they stand before (instances) form a
graph.  Over ROUNDS rounds a pattern's score weighs its trusted distinct
instances against its known negatives (plain numbers, dates, times; one
pseudo-count more), and an instance is trusted as far as the best pattern with
at least MIN_TRUST trusted instances and a score of MIN_SCORE or more.  Tokens
not yet seen count neither way.  Tokens after such patterns that no base entity
covers are reported as kind ``id``.  The word before a token is a pattern too,
used for tokens with only one word before them.

Offsets are code points, end exclusive.  Null texts are empty and have no
spans.  Rows are found again by id and a hash of the text, so repeated rows
get equal results.  An empty table gives an empty table.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

ROUNDS = 3
MIN_TRUST = 5.0
MIN_SCORE = 0.8
MIN_LENGTH, MIN_DIGITS = 6, 4   # of a token that may be reported
BLOCK = 256
SIDE = 64         # spans or tokens compared with each other at a time
PAGE = 4096       # code points of text cut at a time
KINDS = ("email", "ip", "card", "phone")
FOUND = "id"

# The patterns of the base entities.  Possessive quantifiers and the looks
# behind change no match: a match can only begin where a run of its first
# class does, or where the match before ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_GUARD = {"email": "@", "phone": "+"}
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
# Tokens known not to be personal: short, grouped or decimal numbers, ordinals,
# dates and times.
_NUMBER = (r"\A(?:[+-]?[$\u20ac\u00a3]?(?:[0-9]{1,5}|[0-9]{1,3}(?:[,.][0-9]{3})*(?:[.,][0-9]{1,2})?|[0-9]+\.[0-9]+)"
           r"(?:%|st|nd|rd|th)?|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}([./-])[0-9]{1,2}\1(?:[0-9]{4}|[0-9]{2})"
           r"|[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)\z")
_SPAN = "array<struct<start:int,end:int,value:string>>"


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def term(i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), term), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    value = span["value"]
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda a, v: a + v)


def _located(pieces: Column, matches: Column) -> Column:
    """Matches with their offsets, from the pieces of text between them.  Sums
    of BLOCK lengths keep the work linear where a text has many matches."""
    steps = F.zip_with(pieces, matches, lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0)))
    block = lambda i: F.floor(i / BLOCK).cast("int")

    def sums(s):
        own = F.transform(F.sequence(F.lit(0), block(F.size(s))), lambda k: _total(
            F.slice(s, k * BLOCK + 1, F.lit(BLOCK))))
        return _let(own, lambda o: F.transform(o, lambda _, k: _total(F.slice(o, F.lit(1), k))))

    def spans(s):
        def one(m, i, before):
            begin = (F.get(before, block(i)) + _total(F.slice(s, block(i) * BLOCK + 1, i % BLOCK))
                     + F.length(F.get(pieces, i)))
            return _let(begin, lambda b: F.struct(b.alias("start"), (b + F.length(m)).alias("end"),
                                                  m.alias("value")))
        return _let(sums(s), lambda before: F.transform(matches, lambda m, i: one(m, i, before)))

    return _let(steps, spans)


def _matches(text: str, pattern: str, guard: Column, name: str) -> list[Column]:
    """Columns ``<name>_pieces`` and ``<name>_found``; nothing is searched where
    ``guard`` does not hold."""
    t = F.col(text)
    return [F.when(guard, F.split(t, pattern, -1)).alias(f"{name}_pieces"),
            F.when(guard, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).alias(f"{name}_found")]


def base_entities(df: DataFrame, text: str) -> DataFrame:
    """``df`` plus one column of spans (start, end, value) for each base kind."""
    t = F.col(text)
    digits = t.rlike("[0-9]")
    guards = {k: digits if k not in _GUARD else t.contains(_GUARD[k]) for k in KINDS}
    columns = [c for k in KINDS for c in _matches(text, PATTERNS[k], guards[k], k)]
    df = df.select("*", *columns)
    spans = [F.coalesce(F.filter(_located(F.col(f"{k}_pieces"), F.col(f"{k}_found")), partial(_valid, k)),
                        F.array().cast(_SPAN)).alias(k) for k in KINDS]
    dropped = [f"{k}_{s}" for k in KINDS for s in ("pieces", "found")]
    return df.select("*", *spans).drop(*dropped)


def _chunks(xs: Column, size: int) -> Column:
    """``xs`` in parts of ``size`` elements, in order."""
    last = F.greatest(F.floor((F.size(xs) - 1) / size), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(xs, k * size + 1, F.lit(size)))


def _beside_spans(tokens: Column, spans: Column, use) -> Column:
    """``use(token, i, near)`` for every token, where ``near`` holds the spans that
    touch its neighbourhood.  Tokens and spans are dealt in parts of SIDE in the order
    of their starts, and only parts that overlap meet, so that the work stays in
    proportion to the text."""
    def ranged(part):
        return F.struct(F.get(part, F.lit(0))["start"].alias("low"),
                        F.array_max(F.transform(part, lambda x: x["end"])).alias("high"), part.alias("spans"))

    def of_part(part, k, ranges):
        low, high = F.get(part, F.lit(0))["start"], F.element_at(part, -1)["end"]
        touched = F.flatten(F.transform(F.filter(
            ranges, lambda r: (r["low"] < high) & (r["high"] > low)), lambda r: r["spans"]))
        return _let(F.filter(touched, lambda x: (x["start"] < high) & (x["end"] > low)),
                    lambda near: F.transform(part, lambda m, i: use(m, k * SIDE + i, near)))

    return _let(F.transform(_chunks(spans, SIDE), ranged), lambda ranges: F.flatten(F.transform(
        F.filter(_chunks(tokens, SIDE), lambda part: F.size(part) > 0), lambda part, k: of_part(part, k, ranges))))


def _candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` plus ``tokens``: tokens with digits or ``@`` and their pattern.
    ``word`` is the last word of its pattern; ``seed`` tells that a base entity
    begins in the token, ``free`` that none touches it, ``negative`` that it is
    free and known not to be personal."""
    df = df.select("*", *_matches(text, _TOKEN, F.col(text).rlike("[0-9@]"), "token"))
    spans = F.array_sort(F.concat(*[F.transform(k, lambda s, rank=n: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(rank).alias("kind"), s["value"].alias("value")))
        for n, k in enumerate(KINDS)]))

    def token(m, i, pieces, near):
        head = F.when(i > 0, F.lit("# ")).otherwise(F.lit(""))
        before = F.concat(head, F.get(pieces, i))
        words = F.regexp_extract(before, r"(?<!\S)(?:\S++\s++)?\S++\s*+\z", 0)
        lead = F.length(F.regexp_extract(m["value"], r"\A[\"'(\[<{]*+", 0))
        core = F.regexp_extract(m["value"], r"\A[\"'(\[<{]*+(.*?)[\"')\]>}.,;:!?]*+\z", 1)
        # the first by kind, then start, of those that begin in the token
        inside = F.array_min(F.transform(
            F.filter(near, lambda b: (b["start"] >= m["start"]) & (b["start"] < m["end"])),
            lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["value"].alias("value"))))
        free = ~F.exists(near, lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"]))
        pattern = F.lower(F.regexp_replace(F.regexp_replace(words, r"\A\s+|\s+\z", ""), r"\s+", " "))
        found = F.struct(lead.alias("lead"), core.alias("core"), inside.alias("inside"), free.alias("free"),
                         pattern.alias("pattern"))
        return _let(found, lambda x: F.struct(
            (m["start"] + x["lead"]).alias("start"), (m["start"] + x["lead"] + F.length(x["core"])).alias("end"),
            x["pattern"].alias("pattern"), F.substring_index(x["pattern"], " ", -1).alias("word"),
            F.coalesce(x["inside"]["value"], x["core"]).alias("instance"),
            x["inside"].isNotNull().alias("seed"), x["free"].alias("free"),
            (x["free"] & x["core"].rlike(_NUMBER)).alias("negative")))

    may = lambda x: (x["pattern"] != "") & (x["seed"] | x["negative"] | (x["free"] & (
        F.length(x["instance"]) >= MIN_LENGTH) & (
        F.length(F.regexp_replace(x["instance"], "[^0-9]", "")) >= MIN_DIGITS)))
    held = F.struct(F.col("token_pieces").alias("pieces"), spans.alias("spans"),
                    _located(F.col("token_pieces"), F.col("token_found")).alias("tokens"))
    tokens = _let(held, lambda h: _beside_spans(h["tokens"], h["spans"], lambda m, i, near: token(
        m, i, h["pieces"], near)))
    return df.withColumn("tokens", F.filter(tokens, may)).drop("token_pieces", "token_found")


def trusted_patterns(uses: DataFrame) -> DataFrame:
    """Patterns of high confidence, from (pattern, instance, seed): ROUNDS of
    scoring patterns by their instances and instances by their patterns.

    With a column ``negative`` only those instances count against a pattern,
    are never trusted, and only uses with ``learns`` pass trust on to their
    instances; without it, all instances that are not trusted count against it."""
    known = "negative" in uses.columns
    flags = {"seed": F.col("seed"), "negative": F.col("negative") if known else F.lit(False),
             "learns": F.col("learns") if known else F.lit(True)}
    edges = written(uses.groupBy("pattern", "instance").agg(
        *[F.max(c.cast("int")).alias(n) for n, c in flags.items()]), "pattern-graph")
    counts = (F.col("trust").isNotNull() | (F.col("negative") == 1)) if known else F.lit(True)
    seeds = edges.filter("seed = 1").select("instance", F.lit(1.0).alias("trust")).distinct()
    trust, best = seeds, None
    for _ in range(ROUNDS):
        scored = (edges.join(trust, "instance", "left").groupBy("pattern")
                  .agg(F.sum(F.coalesce("trust", F.lit(0.0))).alias("trusted"), F.count(F.when(counts, 1)).alias("n")))
        best = written(scored.withColumn("score", F.col("trusted") / (F.col("n") + 1))
                       .filter((F.col("trusted") >= MIN_TRUST) & (F.col("score") >= MIN_SCORE))
                       .select("pattern", "score"), "patterns")
        learned = (edges.filter("seed = 0 and negative = 0 and learns = 1").join(best, "pattern").groupBy("instance")
                   .agg(F.max("score").alias("trust")))
        trust = seeds.unionByName(learned).groupBy("instance").agg(F.max("trust").alias("trust"))
    return best


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``text_hash``, the spans of each base kind
    and ``found`` (start and end of the tokens discovered by patterns)."""
    source = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"),
                         F.coalesce(F.col(text), F.lit("")).alias("text"))
    based = written(_candidates(base_entities(source, "text"), "text").drop("text"), "entities")
    tokens = based.select("id", "text_hash", F.explode("tokens").alias("x")).select("id", "text_hash", "x.*")
    # A token with two words before it also counts for the last one alone.  A
    # negative is told apart by pattern, so that no plain number is a hot key.
    uses = tokens.select(
        F.explode(F.array_distinct(F.array("pattern", "word"))).alias("use"), "*").select(
        F.col("use").alias("pattern"),
        F.when(F.col("negative"), F.concat_ws(" ", "use", F.lit("#"), "instance"))
        .otherwise(F.col("instance")).alias("instance"),
        "seed", "negative", (F.col("use") == F.col("pattern")).alias("learns"))
    best = trusted_patterns(uses)
    found = (tokens.filter("free and not seed and not negative").join(best, "pattern")
             .groupBy(F.col("id").alias("i"), F.col("text_hash").alias("h"))
             .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("found")))
    joined = based.join(found, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h")), "left")
    return joined.select(F.col("id").alias(doc_id), "text_hash", *KINDS,
                         F.coalesce("found", F.array().cast("array<struct<start:int,end:int>>")).alias("found"))


def _named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"),
                                                    s["end"].cast("string")))


def base_text(kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the base spans, by kind, then start, comma-joined."""
    return F.concat_ws(",", *[_named(k, F.col(k)) for k in kinds])


def all_text() -> Column:
    return F.concat_ws(",", *[_named(k, F.col(k)) for k in KINDS], _named(FOUND, F.col("found")))


def _reached(ends: Column) -> Column:
    """For every element and the end of ``ends``, the greatest of those before
    it, 0 at the front."""
    top = lambda xs: F.coalesce(F.array_max(xs), F.lit(0))

    def within(part, before):
        return F.transform(part, lambda _, i: F.greatest(before, top(F.slice(part, F.lit(1), i))))

    def all_parts(parts):
        return _let(F.transform(parts, top), lambda tops: F.flatten(F.transform(
            parts, lambda part, k: within(part, top(F.slice(tops, F.lit(1), k))))))
    return F.concat(_let(_chunks(ends, BLOCK), all_parts), F.array(top(ends)))


def _replaced(text: Column, spans: Column) -> Column:
    """``text`` with each stretch covered by ``spans`` (start, end, kind; sorted)
    replaced by the kind of its first span.  The text is cut out of pages of PAGE
    code points, so that a cut does not scan the text from its start."""
    def build(pages, reached):
        def cut(a, b):
            first = F.floor(a / PAGE).cast("int")
            held = F.array_join(F.slice(pages, first + 1, F.floor(b / PAGE).cast("int") - first + 1), "")
            return F.substring(held, a - first * PAGE + 1, b - a)

        def shown(s, i):
            at = F.get(reached, i)
            return F.when(s["start"] >= at, F.concat(cut(at, s["start"]), F.lit("["), s["kind"], F.lit("]"))
                          ).otherwise("")
        return F.concat(F.array_join(F.transform(spans, shown), ""), cut(F.element_at(reached, -1), F.length(text)))

    held = F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}+"), F.lit(0)).alias("pages"),
                    _reached(F.transform(spans, lambda s: s["end"])).alias("reached"))
    return _let(held, lambda h: build(h["pages"], h["reached"]))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets
    (overlapping spans by the kind of the first)."""
    spans = find(docs, doc_id, text)
    def labelled(kind, s):
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    marked = [F.transform(F.col(k), partial(labelled, n.upper()))
              for k, n in zip((*KINDS, "found"), (*KINDS, FOUND))]
    spans = (spans.withColumn("spans", F.array_sort(F.concat(*marked))).filter(F.size("spans") > 0)
             .select(F.col(doc_id).alias("__i"), F.col("text_hash").alias("__h"), F.col("spans").alias("__s"))
             .dropDuplicates(["__i", "__h"]))
    t = F.col(f"`{text}`")
    joined = docs.join(spans.hint("shuffle_hash"), F.col(doc_id).eqNullSafe(F.col("__i"))
                       & (F.xxhash64(t) == F.col("__h")), "left")
    clean = _replaced(t, F.col("__s"))
    return joined.select(*[(F.when(F.col("__s").isNull(), t).otherwise(clean) if c == text
                            else F.col(f"`{c}`")).alias(c) for c in docs.columns])
