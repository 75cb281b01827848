r"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base entities (e-mail, IP, card and phone numbers) are found by pattern in every whole text and checked.
They seed a graph of lexical patterns (the word before, the two words before, and the word after) and the
values seen in them. Round by round, a pattern is trusted when the share of its distinct values that are
known is high beyond chance (Wilson lower bound), and every identifier-like value of a trusted pattern
becomes known; rounds end when one adds nothing, which must come as values only ever get known. The
occurrences of discovered values are added as spans of kind ``id``; base spans stay.

An identifier-like value is a word with at least ``MIN_DIGITS`` digits that overlaps no base span.

Defined results: a null or empty text has no span. Repeated rows are scored once (the graph holds distinct
pairs) and each gets its result; a null ``doc_id`` is carried through; an empty table gives no rows. Spans
are code points with an exclusive end. A text of any length takes time about in proportion to its length and number of
matches. Only ``doc_id`` and ``text`` are read (``redact`` keeps the rest).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillscope.llm.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
MIN_DIGITS = 6
MIN_CONFIDENCE = 0.75
REACH = 80  # characters on either side in which a context word is looked for
RUN, PIECE = 128, 256  # sizes of the blocks that keep the work linear in a text's matches and characters

# The stated patterns, with possessive repeats and a start that cannot lie inside a run already tried,
# so that every text is read in linear time; \G is the end of the match before.
LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD_WITH_DIGIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def term(i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(i % 2 == 0, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda total, i: total + term(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.rlike(value, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once per row, wherever the optimiser moves expressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running totals of non-negative ints. Arrays are extended by copying, so blocks of ``RUN`` keep copies short."""
    none = F.array().cast("array<int>")

    def scan(some: Column) -> Column:
        def add(acc: Column, value: Column) -> Column:
            total = combine(acc["total"], value)
            return F.struct(total.alias("total"), F.concat(acc["all"], F.array(total)).alias("all"))
        return F.aggregate(some, F.struct(F.lit(0).alias("total"), none.alias("all")), add, lambda acc: acc["all"])

    def whole(held: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(held) - 1) / RUN).cast("int")),
                             lambda i: scan(F.slice(held, i * RUN + 1, F.lit(RUN))))
        def after(inner: Column) -> Column:
            before = F.concat(F.array(F.lit(0)), scan(F.transform(inner, lambda one: F.element_at(one, -1))))
            return F.flatten(F.zip_with(inner, F.slice(before, F.lit(1), F.size(inner)), lambda one, base: F.transform(
                one, lambda value: combine(base, value))))
        return F.when(F.size(held) > 0, _let(blocks, after)).otherwise(none)

    return _let(values, whole)


def _matches(text: Column, pattern: str) -> Column:
    """All matches as (start, end, value): what stands between them gives their places."""
    def placed(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern), F.lit(1), F.size(found)), F.length)
        ends = _running(F.zip_with(found, gaps, lambda value, gap: gap + F.length(value)), lambda a, b: a + b)
        return F.zip_with(found, ends, lambda value, end: F.struct(
            (end - F.length(value)).alias("start"), end.alias("end"), value.alias("value")))
    return _let(F.regexp_extract_all(text, F.lit(pattern), 0), placed)


def _pieces(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points, as a place in a string is found by reading up to it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), 0)


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """The code points from start to end of a text in pieces, reading no others."""
    first = F.floor(start / PIECE).cast("int")
    some = F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1)
    return F.substring(F.array_join(some, ""), start - first * PIECE + 1, end - start)


def _uncovered(spans: Column, ordered: Column) -> Column:
    """The spans that overlap none of ``ordered``, whose spans do not overlap each other; by binary search."""
    def search(powers: Column) -> Column:
        def free(span: Column) -> Column:
            before = F.aggregate(powers, F.lit(0), lambda n, step: F.when(
                F.get(ordered, n + step - 1)["start"] < span["end"], n + step).otherwise(n))
            return F.coalesce(F.get(ordered, before - 1)["end"] <= span["start"], F.lit(True))
        return F.filter(spans, free)

    steps = F.sequence(F.floor(F.log2(F.size(ordered).cast("double"))).cast("int"), F.lit(0), F.lit(-1))
    powers = F.transform(steps, lambda k: F.pow(F.lit(2), k).cast("int"))
    return F.when((F.size(ordered) > 0) & (F.size(spans) > 0), _let(powers, search)).otherwise(spans)


def _letters(words: Column) -> Column:
    return F.filter(F.split(F.lower(F.regexp_replace(words, r"[^\p{L}\x20]", " ")), " +"), lambda w: w != "")


def _patterns(pieces: Column, size: Column, start: Column, end: Column) -> Column:
    """The lexical patterns of a span: word before, two words before, word after."""
    before = _letters(_cut(pieces, F.greatest(start - REACH, F.lit(0)), start))
    after = _letters(_cut(pieces, end, F.least(end + REACH, size)))
    last, last_two = F.get(before, F.size(before) - 1), F.array_join(F.slice(before, F.greatest(
        F.size(before) - 1, F.lit(1)), F.lit(2)), " ")
    return F.filter(F.array(
        F.concat(F.lit("< "), last), F.when(F.size(before) >= 2, F.concat(F.lit("<< "), last_two)),
        F.concat(F.lit("> "), F.get(after, F.lit(0)))), lambda p: p.isNotNull())


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, others): checked base entities and other identifier-like words of each row."""
    text = F.col("text")
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    has_digit = F.rlike(text, F.lit("[0-9]"))
    needs = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")) & has_digit}
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumns({
        kind: F.when(needs.get(kind, has_digit), _matches(text, PATTERNS[kind])).otherwise(none) for kind in KINDS})
    rows = rows.withColumn("word", F.when(has_digit, _matches(text, WORD_WITH_DIGIT)).otherwise(none))

    def valid(kind: str) -> Column:
        return F.filter(kind, lambda m: _valid(kind, m["value"]))

    def numbered(number: int, kind: str) -> Column:
        return F.transform(kind, lambda m: F.struct(
            F.lit(number).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))

    rows = rows.withColumns({kind: valid(kind) for kind in KINDS})
    rows = rows.withColumn("base", F.concat(*[numbered(number, kind) for number, kind in enumerate(KINDS)]))

    def trimmed(m: Column) -> Column:
        lead = F.length(m["value"]) - F.length(F.regexp_replace(m["value"], r"^[^\p{L}0-9]++", ""))
        value = F.regexp_replace(m["value"], r"^[^\p{L}0-9]++|(?<![^\p{L}0-9])[^\p{L}0-9]++$", "")
        start = m["start"] + lead
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"))

    rows = rows.withColumn("others", F.filter(F.transform("word", trimmed), lambda m: F.length(_digits(m["value"])) >= MIN_DIGITS))
    for kind in KINDS:
        rows = rows.withColumn("others", _uncovered(F.col("others"), F.col(kind)))

    def with_patterns(spans: str) -> Column:
        made = _let(F.struct(_pieces(text).alias("pieces"), F.length(text).alias("size"), F.col(spans).alias("spans")),
                    lambda row: F.transform(row["spans"], lambda m: F.struct(
                        m["start"].alias("start"), m["end"].alias("end"), F.xxhash64(m["value"]).alias("value"),
                        _patterns(row["pieces"], row["size"], m["start"], m["end"]).alias("patterns"))))
        nothing = F.array().cast("array<struct<start:int,end:int,value:bigint,patterns:array<string>>>")
        return F.when(F.size(spans) > 0, made).otherwise(nothing)

    return rows.select(
        "doc_id", F.xxhash64("text").alias("text_key"),
        F.transform("base", lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"))).alias("base"),
        with_patterns("base").alias("seeds"), with_patterns("others").alias("others"))


def _wilson(known: Column, total: Column, z: float = 1.96) -> Column:
    """Lower bound of the share of known values among all."""
    share = known / total
    spread = F.sqrt(share * (1 - share) / total + z * z / (4 * total * total))
    return (share + z * z / (2 * total) - z * spread) / (1 + z * z / total)


def discovered_values(scratch: Scratch, found: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Hashes of the identifier-like values that trusted patterns discover, grown to a fixed point."""
    def edges(column: str) -> DataFrame:
        one = found.select(F.explode(column).alias("m"))
        return one.select(F.col("m.value").alias("value"), F.explode("m.patterns").alias("pattern"))

    graph = scratch.keep(edges("seeds").unionByName(edges("others")).distinct(), "graph")
    known = scratch.keep(found.select(F.explode("seeds").alias("m")).select(
        F.col("m.value").alias("value"), F.lit(0).alias("round")).distinct(), "known-0")
    step, new = 0, 1
    while new:
        marked = graph.join(known, "value", "left")
        scores = marked.groupBy("pattern").agg(F.count("round").alias("known"), F.count(F.lit(1)).alias("total"))
        trusted = scores.where((F.col("known") < F.col("total")) & (
            _wilson(F.col("known"), F.col("total")) >= min_confidence)).select("pattern")
        fresh = marked.where(F.col("round").isNull()).join(trusted, "pattern", "left_semi").select(
            "value", F.lit(step + 1).alias("round")).distinct()
        step += 1
        fresh = scratch.keep(fresh, f"fresh-{step}")
        new = fresh.limit(1).count()
        known = scratch.keep(known.unionByName(fresh), f"known-{step}")
        scratch.drop(f"known-{step - 1}", f"fresh-{step}")
    scratch.drop("graph")
    return known.where("round > 0").select("value")


def find_personal_data(docs: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(doc_id, text_key, spans) of every row; spans are (kind, start, end), kind a place in ``KINDS`` or after."""
    scratch = Scratch(docs.sparkSession, "pii")
    found = base_spans(docs).withColumn("row", F.monotonically_increasing_id())
    found = scratch.keep(found, "found")
    values = discovered_values(scratch, found, min_confidence)
    others = found.select("row", F.explode("others").alias("m")).select("row", "m.start", "m.end", "m.value")
    extra = others.join(values, "value", "left_semi").groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        F.lit(len(KINDS)).alias("kind"), "start", "end"))).alias("extra"))
    rows = found.select("row", "doc_id", "text_key", "base").join(extra, "row", "left")
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return rows.select("doc_id", "text_key", F.concat("base", F.coalesce("extra", none)).alias("spans"))


def span_digests(found: DataFrame) -> DataFrame:
    """Counts and digests per row of ``find_personal_data``."""
    names = F.array(*map(F.lit, (*KINDS, FOUND)))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))

    def counted(number: int, kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    counts = [counted(number, kind) for number, kind in enumerate((*KINDS, FOUND))]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans become one."""
    names = F.array(*[F.lit(f"<{kind}>") for kind in (*KINDS, FOUND)])
    found = find_personal_data(docs, min_confidence).where(F.size("spans") > 0)
    found = found.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.first("spans").alias("__spans"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == F.col("__key"))
    rows = docs.join(found, same, "left")
    ordered = F.sort_array(F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.col("text")

    def written(row: Column) -> Column:
        spans, count = row["spans"], F.size(row["spans"])
        reached = _running(F.transform(spans, lambda s: s["end"]), F.greatest)  # the furthest end so far
        def joined(ends: Column) -> Column:
            starts = F.slice(F.concat(F.array(F.lit(0)), ends), F.lit(1), count)
            parts = F.zip_with(spans, starts, lambda s, at: F.when(s["start"] < at, F.lit("")).otherwise(
                F.concat(_cut(row["pieces"], at, s["start"]), F.get(names, s["kind"]))))
            return F.concat(F.array_join(parts, ""), _cut(row["pieces"], F.element_at(ends, -1), F.length(text)))
        return _let(reached, joined)

    cleaned = _let(F.struct(_pieces(text).alias("pieces"), ordered.alias("spans")), written)
    new = F.when(F.col("__spans").isNull(), text).otherwise(cleaned)
    return rows.select(*[new.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
