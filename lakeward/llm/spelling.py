"""Spelling variants: words that one inserted, deleted or replaced character parts, by permuterm rotations.

A word of the code points c_1 .. c_L is marked with a terminator; its
rotations are ``c_{i+1} .. c_L $ c_1 .. c_i``.  In the rotation that ends in an
edited character, everything before that character is the same in both words,
so an edit is a common prefix:

- words that a replacement parts agree in a rotation without its last character;
- a word that lacks a character has a whole rotation that is the other word's
  rotation without its last character.

All rotations are sorted by that prefix, and each range of equal prefixes is
scanned once.  Every member of a range is near every other one.  A range holds
one whole rotation at most, and of the skipping ones one for each character of
the alphabet, so it is small whatever the corpus.  It emits no pairs: each
member gets the number of the others and the most frequent of them, and sums and
maxima over a word's ranges are its result.  Two words meet in one range only if
a replacement parts them; where one has a longer run of the same character they
meet in a range for each place of the run, of which the first counts.

Keys of long words are digests of the two parts about the terminator, and
rows carry a word's place in the sorted list of words instead of its text, so
a word's rotations take space in proportion to its length.

Defined results: NULL text has no words; a NULL id counts as the empty text
in the rule that misspells words; rows that repeat an id or a text count each;
an empty table has no words; a word of any length takes part; other columns
are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import stage, text_or_empty

MIN_LENGTH, MIN_COUNT = 7, 2
#: A form is so many times as frequent as its variants at least.
RATIO = 10
#: One in so many (document, word) pairs is misspelt by the query's rule.
TYPO_EVERY = 31
#: Different words that a task counts before it passes them on.
COUNT_FLUSH = 300_000
#: Keys of more letters are digests.
LONG = 64
END = "$"
WHOLE, SKIP_FIRST, SKIP_OTHER = 0, 1, 2


def words_of(doc_id: str, text: str, min_length: int, typo_every: int | None) -> Counter[str]:
    """The text's runs of letters with A-Z in lower case, some of them without one code point, by crc32."""
    lower = text.encode().lower().decode()  # bytes have ASCII cases only
    found = Counter(re.findall(f"[a-zÀ-ÿ]{{{min_length},}}", lower))
    if not typo_every:
        return found
    head, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, k in found.items():
        h = zlib.crc32(run.encode(), head)
        if h % typo_every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < min_length:
                continue
        out[run] += k
    return out


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
    typo_every: int | None = None,
) -> DataFrame:
    """word, n: the corpus' words of at least ``min_length`` code points and ``min_count`` occurrences.

    Tasks pass on partial sums, so a word that fills a third of all texts is a
    few rows of the shuffle.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        frame = lambda: pd.DataFrame({"word": list(total), "n": list(total.values())})
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                total.update(words_of(doc_id, text, min_length, typo_every))
                if len(total) > COUNT_FLUSH:
                    yield frame()
                    total.clear()
        if total:
            yield frame()

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), text_or_empty(text_col).alias("text"))
    parts = texts.mapInPandas(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _digests(word: str) -> list[str]:
    """Digests of the word's prefixes, from the empty one on."""
    h = blake2b(digest_size=16)
    out = [h.hexdigest()]
    for c in word:
        h.update(c.encode())
        out.append(h.hexdigest())
    return out


def rotations(word: str, long: int = LONG) -> list[tuple[str, int]]:
    """Keys of the word's rotations: whole ones, and without their last character, of which a run's first is marked."""
    n = len(word)
    if n > long:  # as digests where the key has more letters than that
        heads, tails = _digests(word), _digests(word[::-1])[::-1]
        key = lambda to, since, letters: (
            word[since:] + END + word[:to] if letters <= long else tails[since] + END + heads[to])
        return [(key(i, i, n), WHOLE) for i in range(n + 1)] + [
            (key(i, i + 1, n - 1), SKIP_OTHER if i and word[i - 1] == word[i] else SKIP_FIRST) for i in range(n)]
    return [(word[i:] + END + word[:i], WHOLE) for i in range(n + 1)] + [
        (word[i + 1:] + END + word[:i], SKIP_OTHER if i and word[i - 1] == word[i] else SKIP_FIRST) for i in range(n)]


def _index(words: DataFrame, long: int) -> DataFrame:
    """key, kind, id, n: the rotations of (id, word, n)."""

    def turned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(*r, i, n) for i, w, n in zip(pdf["id"].tolist(), pdf["word"], pdf["n"].tolist()) for r in rotations(w, long)]
            yield pd.DataFrame(rows, columns=["key", "kind", "id", "n"])

    return words.select("id", "word", "n").mapInPandas(turned, "key string, kind int, id long, n long")


def _scanned(index: DataFrame) -> DataFrame:
    """id, near, best (n, id): of each word's ranges with several members, the other members' number and their most frequent."""
    by_count = Window.partitionBy("key").orderBy(F.desc("n"), "id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    member = F.struct("n", "id")
    of_kind = lambda *kinds: F.sum(F.col("kind").isin(*kinds).cast("int")).over(by_count)
    ranges = index.select(
        "id", "kind", F.first(member).over(by_count).alias("first"), F.nth_value(member, 2).over(by_count).alias("second"),
        of_kind(WHOLE).alias("whole"), of_kind(SKIP_FIRST).alias("firsts"), of_kind(SKIP_FIRST, SKIP_OTHER).alias("skips"),
    ).where(F.col("second").isNotNull())
    near = F.when(F.col("kind") == WHOLE, F.col("firsts")).otherwise(
        F.col("skips") - 1 + F.when(F.col("kind") == SKIP_FIRST, F.col("whole")).otherwise(0))
    best = F.when(F.col("first.id") == F.col("id"), F.col("second")).otherwise(F.col("first"))
    return ranges.select("id", near.alias("near"), best.alias("best")).groupBy("id").agg(
        F.sum("near").cast("long").alias("n_near"),
        F.max(F.struct(F.col("best.n").alias("n"), (-F.col("best.id")).alias("minus_id"))).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """id, root: where each chain of (id, form_id) ends, by doubling.

    A form is ``ratio`` times as frequent as its variant, so chains are as
    short as the logarithm of the largest count, and the rounds are few.
    """
    links = stage(forms.select("id", F.col("form_id").alias("root")), "links")
    while True:
        on = links.select(F.col("id").alias("root"), F.col("root").alias("next"))
        followed = links.join(on, "root", "left").select(
            "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        followed = stage(followed, "links")
        links = followed.drop("moved")
        if followed.where("moved").isEmpty():
            return links


def spelling_variants(words: DataFrame, ratio: int = RATIO, long: int = LONG) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n; the words differ).

    ``n_near`` counts the words that one edit parts from this one; ``form`` is
    the most frequent of them (of equal ones the first in code-point order) if
    it is ``ratio`` times as frequent or more; ``root`` is where forms lead to.
    """
    words = stage(words.select("word", F.col("n").cast("long").alias("n")), "counts")
    # ids in the order of the words, so that ties need no text
    ordered = words.repartitionByRange("word").sortWithinPartitions("word")
    words = stage(ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    near = stage(_scanned(_index(words, long)), "near")
    mine = words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.minus_id")).alias("form_id"))
    mine = stage(mine, "mine")
    roots = _roots(mine.where("form_id is not null"))
    names = lambda name: words.select(F.col("id").alias(f"{name}_id"), F.col("word").alias(name))
    forms = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    linked = mine.where("form_id is not null").join(forms, "form_id").join(
        roots.withColumnRenamed("root", "root_id"), "id").join(names("root"), "root_id")
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    alone = mine.where("form_id is null").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near",
        F.lit(None).cast("long").alias("form_n"))
    return linked.select(*columns).unionByName(alone)
