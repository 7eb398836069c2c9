"""Spelling variants: words one edit apart, found through an index of grams of variable length.

``word_counts`` reads the words of all texts, ``near_words`` joins them, ``spelling_variants`` names every word's form.

Method. A word is written between two end marks. Grams are 2 to ``LONGEST`` characters:

1. *Dictionary.* All grams of all words are counted. A gram that stands in more than a share 1/``PARENTS`` of all gram
   places is too common to be looked up, so its longer grams enter the dictionary, but for its rarest ones that together
   stay under that number: those are pruned and still looked up through the shorter gram.
2. *Decomposition.* At each place of a word starts the longest gram of the dictionary that fits there (or the plain
   two characters); a gram that lies inside an earlier one is dropped.
3. *Bound.* One edit can only touch grams that hold its place, or whose choice depends on it: a gram can be replaced by a
   longer one of the dictionary with the same beginning, or be covered by one that holds it. The most grams that an edit
   at any place of a word can touch is that word's bound; both words share all others.
4. *Merging.* Of two near words each must share one of its (bound + 1) rarest grams with the other, at the same place or
   one next to it: only those are posted, under gram, length and place. Words that meet are merged over their whole gram
   lists, and pairs that share fewer grams than both bounds allow are dropped. A mark of 64 bits per word, one bit for the
   hash of each gram, comes first: every bit that the other word lacks is a gram that it lacks.
5. *Verification* by edit distance in code points.

A word of at least 2 ``LONGEST`` characters, end marks included, always keeps a shared gram: the first and the last one
cannot both be touched by one edit. Shorter words are therefore refused (``least_chars``).

The dictionary is bounded by its two parameters (at most ``PARENTS`` parents per length, one longer gram per letter) and is
the only thing sent to tasks. Words, postings and pairs stay in tables; a posting list holds words of one length with one of
their rarest grams at one place. Counts are combined before the shuffle, so a word that fills a third of all texts is one
row per task.

Cases: a NULL or empty text has no words; a NULL id is written as an empty one; repeated rows count each; an empty table
gives an empty result; a text of any length is split in place; of near words with equal counts the smaller one in
code-point order is the form; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.session import materialize

LETTER = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS, LEAST_COUNT, TIMES = 6, 5, 5
SHORTEST, LONGEST, PARENTS = 2, 4, 16384
OPEN, CLOSE = "\x02", "\x03"


def word_counts(docs: DataFrame, text: str = "text", key: str = "doc_id", every: int = 199, least_chars: int = LEAST_CHARS,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of all words with that many characters and occurrences; every ``every``-th run (by a checksum of id and
    run) is misspelt by leaving out one character, 0 misspells none."""
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{LETTER}{{{max(1, least_chars)},}}"), F.lit(0))
                                 ).alias("run"))  # shorter runs give no word
    small = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER))
    runs = runs.select("id", small.alias("run"))
    word = F.col("run")
    if every:
        mark = F.crc32(F.concat_ws(":", "id", "run"))
        at = (mark % F.length("run")).cast("int")
        word = F.when(mark % every == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
                      ).otherwise(word)
    return runs.select(word.alias("word")).filter(F.length("word") >= least_chars).groupBy("word").agg(
        F.count("*").alias("n")).filter(F.col("n") >= least_count)


def grams_of(word: str, longest: int):
    """All grams of a word between its end marks."""
    for size in range(SHORTEST, longest + 1):
        for at in range(len(word) - size + 1):
            yield word[at:at + size]


def gram_dictionary(words: DataFrame, longest: int = LONGEST, parents: int = PARENTS) -> set[str]:
    """The longer grams of the frequency-pruned dictionary."""

    def count(batches):
        for batch in batches:
            found = Counter(g for w in batch.column(0).to_pylist() for g in grams_of(f"{OPEN}{w}{CLOSE}", longest))
            yield pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                  names=["gram", "n"])

    counted = materialize(words.select("word").mapInArrow(count, "gram string, n bigint").groupBy("gram").agg(
        F.sum("n").alias("n")), "grams")
    places = counted.filter(F.length("gram") == SHORTEST).agg(F.sum("n").alias("n")).first()["n"] or 0
    bound = max(1, places // parents)
    # no more than ``parents`` grams of one length stand in more than that share of the places
    common = counted.filter((F.col("n") > bound) & (F.length("gram") < longest)).select(F.col("gram").alias("parent"))
    longer = counted.filter(F.length("gram") > SHORTEST).withColumn("parent", F.expr("left(gram, length(gram) - 1)"))
    children: dict[str, list[tuple[int, str]]] = {}
    for r in longer.join(common, "parent").select("parent", "gram", "n").collect():
        children.setdefault(r["parent"], []).append((r["n"], r["gram"]))
    kept: set[str] = set()
    for parent in sorted(children, key=len):
        if len(parent) > SHORTEST and parent not in kept:
            continue
        pruned = 0
        for n, gram in sorted(children[parent]):
            pruned += n
            if pruned > bound:
                kept.add(gram)
    return kept


class Grams:
    """Decomposition of words by a dictionary, and how many grams one edit can touch."""

    def __init__(self, dictionary: set[str], longest: int):
        self.longest, self.dictionary = longest, dictionary
        self.begins = {g[:n] for g in dictionary for n in range(1, len(g))}
        self.inside = {g[a:b] for g in dictionary for a in range(1, len(g)) for b in range(a + 1, len(g) + 1)}

    def split(self, word: str) -> list[tuple[int, str]]:
        """(place, gram) of a word, end marks added."""
        word, out, covered = f"{OPEN}{word}{CLOSE}", [], 0
        for at in range(len(word) - SHORTEST + 1):
            size = next((n for n in range(min(self.longest, len(word) - at), SHORTEST, -1)
                         if word[at:at + n] in self.dictionary), SHORTEST)
            if at + size > covered:
                covered = at + size
                out.append((at, word[at:at + size]))
        return out

    def touched(self, grams: list[tuple[int, str]], word: str) -> int:
        """The most grams that one inserted, deleted or replaced character can touch."""
        word = f"{OPEN}{word}{CLOSE}"
        hits = np.zeros(len(word) + 1, np.int64)
        for at, gram in grams:
            end = at + len(gram)
            last = end  # the places an edit can touch: from first to last, last not included
            while last < at + self.longest and word[at:last] in self.begins:
                last += 1
            first = at
            while first > end - self.longest and word[first:end] in self.inside:
                first -= 1
            hits[max(0, first):min(last, len(hits))] += 1
        return int(hits.max())


def postings(words: DataFrame, dictionary: set[str], longest: int = LONGEST) -> DataFrame:
    """Per word ``word, chars``, its ``grams`` and their ``places``, ``named`` (each gram with the number of its repetition),
    ``mark`` (bits of its grams) and ``touched``."""

    def cut(batches):
        index = Grams(dictionary, longest)
        for batch in batches:
            rows = []
            for word in batch.column(0).to_pylist():
                split = index.split(word)
                seen: Counter = Counter()
                named = []
                for _, gram in split:
                    named.append(f"{gram}{seen[gram]}")
                    seen[gram] += 1
                grams = [g for _, g in split]
                bits = 0
                for gram in grams:
                    bits |= 1 << crc32(gram.encode()) % 64
                rows.append((word, len(word), grams, [p for p, _ in split], named, bits - (bits >> 63 << 64),
                             index.touched(split, word)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(),
                     pa.int32()]
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                                  names=["word", "chars", "grams", "places", "named", "mark", "touched"])

    return words.select("word").mapInArrow(cut, "word string, chars int, grams array<string>, places array<int>, "
                                                "named array<string>, mark bigint, touched int")


def rare_grams(lists: DataFrame) -> DataFrame:
    """``word, chars, named, mark, touched, gram, place`` of each word's (touched + 1) rarest grams."""
    each = lists.select("word", F.posexplode("grams").alias("nth", "gram"), "places")
    each = each.select("word", "gram", F.get("places", F.col("nth")).alias("place"))
    frequency = each.groupBy("gram").agg(F.count("*").alias("f"))
    ranked = each.join(frequency, "gram").groupBy("word").agg(F.array_sort(F.collect_list(F.struct("f", "gram", "place"))).alias(
        "ranked"))  # a word's own grams: as many as it has characters, at most
    chosen = lists.join(ranked, "word").select(
        "word", "chars", "named", "mark", "touched", F.explode(F.slice("ranked", F.lit(1), F.col("touched") + 1)).alias("g"))
    return chosen.select("word", "chars", "named", "mark", "touched", "g.gram", "g.place")


def near_words(words: DataFrame, longest: int = LONGEST, parents: int = PARENTS,
               least_chars: int = LEAST_CHARS) -> DataFrame:
    """``a, b`` of all pairs of ``words`` that differ by one edit, both ways; words are distinct and have ``least_chars``
    characters at least."""
    if least_chars + 2 < 2 * longest:
        raise ValueError(f"words of {least_chars} characters can lose all grams of {longest} by one edit")
    lists = materialize(postings(words, gram_dictionary(words, longest, parents), longest), "gram_lists")
    rare = materialize(rare_grams(lists), "rare_grams")
    # as long: the same place; one longer: the same place, or one on
    place = F.explode(F.expr("array(named_struct('more', 0, 'by', 0), named_struct('more', 1, 'by', 0), "
                             "named_struct('more', 1, 'by', 1))"))
    asked = rare.select(
        F.col("word").alias("a"), F.col("named").alias("a_named"), F.col("mark").alias("a_mark"), "gram",
        F.col("touched").alias("a_touched"), F.size("named").alias("a_grams"), "chars", "place", place.alias("to")).select(
        "a", "a_named", "a_mark", "a_touched", "a_grams", "gram", (F.col("chars") + F.col("to.more")).alias("chars"),
        (F.col("place") + F.col("to.by")).alias("place"), (F.col("to.more") == 0).alias("as_long"))
    held = rare.select(F.col("word").alias("b"), F.col("named").alias("b_named"), F.col("mark").alias("b_mark"), "gram", "chars",
                       "place", F.col("touched").alias("b_touched"), F.size("named").alias("b_grams"))
    least = F.greatest(F.col("a_grams") - F.col("a_touched"), F.col("b_grams") - F.col("b_touched"))
    # nested, so that the dearer tests are made only where the cheaper ones hold
    marks_allow = ((~F.col("as_long") | (F.col("a") < F.col("b")))
                   & (F.bit_count(F.col("a_mark").bitwiseAND(F.bitwise_not("b_mark"))) <= F.col("a_grams") - least)
                   & (F.bit_count(F.col("b_mark").bitwiseAND(F.bitwise_not("a_mark"))) <= F.col("b_grams") - least))
    lists_allow = F.size(F.array_intersect("a_named", "b_named")) >= least
    near = F.when(marks_allow, F.when(lists_allow, F.levenshtein("a", "b", 1) == 1))
    found = asked.join(held, ["gram", "chars", "place"]).filter(near).select("a", "b").distinct()
    pairs = materialize(found, "near_words")
    return pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: forms (``word, form``) followed to the last one. A form occurs several times as often as its word,
    so chains are short; every round doubles the step."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = materialize(now, "roots")
        step = now.select(F.col("word").alias("__at"), F.col("root").alias("__next"))
        if not now.join(step, F.col("root") == F.col("__at"), "left_semi").limit(1).count():
            return now
        now = now.join(step, F.col("root") == F.col("__at"), "left").select(
            "word", F.coalesce("__next", "root").alias("root"))


def spelling_variants(words: DataFrame, times: int = TIMES, longest: int = LONGEST, parents: int = PARENTS,
                      least_chars: int = LEAST_CHARS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all rows of ``words`` (``word, n``)."""
    words = materialize(words, "words")
    pairs = near_words(words, longest, parents, least_chars)
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    best = pairs.join(counts, "b").groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), "b")).alias("best"))
    often = -F.col("best.less")
    enough: Column = F.coalesce(often >= times * F.col("n"), F.lit(False))
    named = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.b")).alias("form"),
        F.when(enough, often).alias("form_n")), "forms")
    last = roots(named.filter("form IS NOT NULL"))
    return named.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
