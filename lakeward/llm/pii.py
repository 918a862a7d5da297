"""Personal data: fixed kinds plus bootstrapped contextual extraction, by DataFrame functions only.

1. Seeds: e-mail addresses, IP addresses, card and phone numbers by pattern.
2. Every identifier (a seed, or another word-like run that holds a digit or
   an @, or a number in groups that blanks or brackets part) is an instance.
   Its patterns are its lexical contexts, the one word and the two words just
   before it and just after it, whatever the instance's shape.  Patterns and
   instances make a graph.
3. The graph is scored in rounds.  For each kind, a pattern scores the share of
   that kind in its different known instances; what is not known says nothing for
   or against a pattern, however often it occurs.  A pattern's weight is its
   largest score, so a word that follows all kinds hardly counts.  An unknown
   instance scores the weighted mean of its patterns' scores.
4. Patterns with a high score and enough different known instances are trusted.  An
   unknown instance with a high score and a trusted pattern is known from then on
   as one of that kind, if it can be one: e-mail addresses hold an @, the others six
   digits and no @, and numbers in groups are cards or phones.  So it lends weight
   to its other patterns in the next round.  Rounds go on until one finds no
   further instance; each adds some or ends, so they do end.
5. Found spans are the places where an instance that became known stands in a
   trusted context of its kind.

Base spans are never changed; found ones are added.

Defined results: NULL text counts as empty; an empty text or table has no
spans; a pattern that a third of all rows share is summed map-side and
joined back from a written table that AQE can split; rows that repeat an id
give a row each; NULL ids give a row; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import stage, text_or_empty
from lakeward.llm.spans import with_spans

KINDS = ("email", "ip", "card", "phone")

#: The fixed patterns.  Lookbehinds and possessive quantifiers only spare
#: attempts that cannot match: within a run of characters that the first part
#: accepts, a later start fails or succeeds exactly as the first one does.
EMAIL = "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}"
CARD = "[0-9](?:[\\x20-]?[0-9])++"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
#: Any other identifier: a run without blanks and common delimiters that holds a digit or an @.
IDENTIFIER = "(?<![^\\s\"'<>()\\[\\]{},;|])[^\\s\"'<>()\\[\\]{},;|0-9@]*+[0-9@][^\\s\"'<>()\\[\\]{},;|]*+"
#: A number whose groups of digits are parted by blanks or brackets too, as cards and phones may be.
GROUPED = "(?<![^\\s\"'<>()\\[\\]{},;|])\\(?[0-9][\\x20()./0-9-]*[0-9](?![^\\s\"'<>()\\[\\]{},;|])"

#: How far a context's words are looked for; longer ones are no words.
CONTEXT_CHARS = 256
BEFORE = ("(\\p{L}++)[^\\p{L}0-9]{0,3}$", "(\\p{L}++[^\\p{L}0-9]{1,3}\\p{L}++)[^\\p{L}0-9]{0,3}$")
AFTER = ("^[^\\p{L}0-9]{0,3}(\\p{L}++)", "^[^\\p{L}0-9]{0,3}(\\p{L}++[^\\p{L}0-9]{1,3}\\p{L}++)")
MIN_SEEDS = 5
MIN_PATTERN = 0.9
MIN_INSTANCE = 0.8
MIN_DIGITS = 6
#: As many digits as a card has at most; a longer row of groups is no one identifier.
MAX_GROUPED = 19


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _parts_in_range(m: Column) -> Column:
    """All four numbers at most 255, whatever their number of digits."""
    return F.forall(F.split(m, "\\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _luhn(m: Column) -> Column:
    """13 to 19 digits whose Luhn sum is divisible by 10."""
    digits = F.split(F.reverse(_digits(m)), "")
    doubled = F.transform(digits, lambda c, i: F.when(i % 2 == 1, F.element_at(
        F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)).otherwise(c.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return F.when(F.length(_digits(m)).between(13, 19), total % 10 == 0).otherwise(False)


def _kept(kind: str, m: Column) -> Column:
    if kind == "ip":
        return _parts_in_range(m)
    if kind == "card":
        return _luhn(m)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _seeds(kind: str, order: int) -> Column:
    return F.transform(F.filter(kind, lambda x: _kept(kind, x["m"])), lambda x: F.struct(
        F.lit(order).alias("ord"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"),
        x["m"].alias("m"), x["c"].alias("c"), x["r"].alias("r")))


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, base (array of ord, s, e, kind, m, c, r) and other (array of s, e, m, c, r): identifiers apart from them."""
    df = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        text_or_empty(text_col).alias("text"),
    )
    digit = F.col("text").rlike("[0-9]")
    df = df.withColumn("digits", F.when(digit, F.col("text")).otherwise(""))
    has = lambda sign, col: F.when(F.instr(F.col(col), sign) > 0, F.col(col)).otherwise("")
    df = with_spans(df, "email", has("@", "text"), EMAIL, CONTEXT_CHARS)
    df = with_spans(df, "ip", has(".", "digits"), IP, CONTEXT_CHARS)
    df = with_spans(df, "card", F.col("digits"), CARD, CONTEXT_CHARS)
    df = with_spans(df, "phone", has("+", "digits"), PHONE, CONTEXT_CHARS)
    either = F.when(F.col("text").rlike("[0-9@]"), F.col("text")).otherwise("")
    df = with_spans(df, "near", either, IDENTIFIER, CONTEXT_CHARS)
    df = with_spans(df, "grouped", F.col("digits"), GROUPED, CONTEXT_CHARS)
    grouped = F.filter("grouped", lambda x: x["m"].rlike("[\\x20()]") & F.length(_digits(x["m"])).between(MIN_DIGITS, MAX_GROUPED))
    df = df.withColumn("near", F.concat("near", grouped))
    df = df.withColumn("base", F.concat(*[_seeds(k, i) for i, k in enumerate(KINDS)]))
    apart = F.filter("near", lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    return df.select("row", "doc_id", "base", apart.alias("other"))


def _occurrences(df: DataFrame) -> DataFrame:
    """row, s, e, kind (NULL if no seed), instance, pattern: identifiers with each of their lexical contexts."""

    def node(x: Column, kind: Column) -> Column:
        contexts = [F.concat(F.lit(f"{side}{n}:"), F.nullif(F.lower(F.regexp_extract(x[part], pattern, 1)), F.lit("")))
                    for side, part, both in (("<", "c", BEFORE), (">", "r", AFTER)) for n, pattern in enumerate(both, 1)]
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), kind.alias("kind"), F.lower(x["m"]).alias("instance"),
                        F.filter(F.array(*contexts), lambda c: c.isNotNull()).alias("contexts"))

    seeds = F.transform("base", lambda x: node(x, x["kind"]))
    others = F.transform("other", lambda x: node(x, F.lit(None).cast("string")))
    return df.select("row", F.inline(F.concat(seeds, others))).select(
        "row", "s", "e", "kind", "instance", F.explode("contexts").alias("pattern"))


def _can_be(kind: str) -> Column:
    """Whether an instance without a fixed pattern can be of the kind."""
    sign = F.col("instance").contains("@")
    if kind == "email":
        return sign
    enough = ~sign & (F.length(_digits(F.col("instance"))) >= MIN_DIGITS)
    return enough if kind in ("card", "phone") else enough & ~F.col("instance").rlike("[\\x20()]")


def bootstrapped(
    occurrences: DataFrame, min_seeds: int = MIN_SEEDS, min_pattern: float = MIN_PATTERN, min_instance: float = MIN_INSTANCE,
) -> tuple[DataFrame, DataFrame]:
    """Trusted (pattern, of) and found (instance, of) once no round finds any more."""
    edges = stage(occurrences.select("pattern", "instance").distinct(), "edges")
    known = stage(occurrences.where("kind is not null").select("instance", F.col("kind").alias("of")).distinct(), "known")
    found = known.limit(0)
    able = F.lit(False)
    for kind in KINDS:
        able = able | _can_be(kind)
    unknown = stage(edges.where(able).join(known.select("instance").distinct(), "instance", "left_anti"), "unknown")
    shares = [F.col(f"p_{k}") for k in KINDS]
    while True:
        counts = edges.join(known, "instance").groupBy("pattern").agg(
            *[F.count_if(F.col("of") == k).alias(f"n_{k}") for k in KINDS], F.count(F.lit(1)).alias("n"))
        patterns = counts.select("pattern", "n", *[(F.col(f"n_{k}") / F.col("n")).alias(f"p_{k}") for k in KINDS])
        patterns = stage(patterns.withColumn("weight", F.greatest(*shares)), "patterns")
        trusted = lambda k: (F.col(f"p_{k}") >= min_pattern) & (F.col("n") >= min_seeds)
        scores = unknown.join(patterns, "pattern").groupBy("instance").agg(*[
            c for k in KINDS for c in ((F.sum(F.col("weight") * F.col(f"p_{k}")) / F.sum("weight")).alias(f"s_{k}"),
                                       F.bool_or(trusted(k)).alias(f"t_{k}"))])
        options = [F.when(F.col(f"t_{k}") & (F.col(f"s_{k}") >= min_instance) & _can_be(k),
                          F.struct(F.col(f"s_{k}").alias("score"), F.lit(-i).alias("order"), F.lit(k).alias("of")))
                   for i, k in enumerate(KINDS)]
        new = stage(scores.select("instance", F.array_max(F.array(*options)).alias("best")).where("best is not null").select(
            "instance", "best.of"), "new")
        if new.isEmpty():
            good = F.array(*[F.when(trusted(k), F.lit(k)) for k in KINDS])
            return patterns.select("pattern", F.explode(F.filter(good, lambda k: k.isNotNull())).alias("of")), found
        found, known = stage(found.union(new), "found"), stage(known.union(new), "known")
        unknown = stage(unknown.join(new.select("instance"), "instance", "left_anti"), "unknown")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per row of ``docs``: doc_id, base, added (arrays of ord, s, e, kind).

    ``limits`` are those of :func:`bootstrapped`.
    """
    found = stage(base_spans(docs, id_col, text_col), "base")
    occurrences = stage(_occurrences(found), "occurrences")
    good, new = bootstrapped(occurrences, **limits)
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("of")).cast("int") - 1
    hits = (
        occurrences.where("kind is null")
        .join(stage(good, "trusted"), "pattern").join(new, ["instance", "of"])
        .groupBy("row").agg(F.collect_set(F.struct(order.alias("ord"), "s", "e", F.col("of").alias("kind"))).alias("added"))
    )
    none = F.array().cast("array<struct<ord:int,s:int,e:int,kind:string>>")
    base = F.transform("base", lambda x: F.struct(x["ord"], x["s"], x["e"], x["kind"]))
    return found.select("row", "doc_id", base.alias("base")).join(hits, "row", "left").select(
        "doc_id", F.array_sort("base").alias("base"), F.array_sort(F.coalesce("added", none)).alias("added"))
