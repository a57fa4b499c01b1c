"""Spelling variants by an index of variable-length grams.

Words stand between a start and an end mark. Of all words' grams the frequent ones form a
dictionary: a gram is as short as possible, but a frequent one is extended by the next
character, up to a greatest length. A word is decomposed into the grams that start at its
places; one that lies inside an earlier one is left out.

An edit of one character affects the grams that cover its place and those that an
earlier, longer gram could swallow instead; each gram has a window of places outside of
which no edit affects it. So for every place of an edit the word's unaffected grams are
known: those before it keep their distance from the start, those behind it theirs from
the end. A near word has just these grams at these places, and their lists are merged by
one key: two words are near only if they share the key of some edit. Words in a merged list
differ in the short part between the two outer grams at most, which decides by edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import short_batches, stored, text_or_empty
from recurra.llm.textarrays import BASE, mix

#: a second multiplier, so that keys have 128 bits
OTHER = np.uint64(0xD6E8FEB86659FD93)
RUNS = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
START, END = 1, 2
#: words that a task counts before it hands them on
HELD = 200_000


@dataclass(frozen=True)
class Params:
    #: code points of the shortest word, and its least count
    least: int = 7
    repeats: int = 2
    #: lengths of grams
    shortest: int = 2
    longest: int = 4
    #: a gram is frequent if it stands at more than ``positions / nodes`` places, so there are at most so many of one length
    nodes: int = 2_000
    #: a form occurs so many times as often as its variant
    factor: int = 10

    def __post_init__(self) -> None:
        if not 1 <= self.shortest <= self.longest or self.least < 2 * self.longest - 2:
            raise ValueError("words must have room for two grams of the longest kind beside an edit")


def count_words(docs: DataFrame, params: Params = Params(), changed: int | None = None) -> DataFrame:
    """(word, n) of all runs of letters with at least ``least`` code points, A to Z in lower case.

    With ``changed``, one character is taken out of some runs: where the checksum of ``<doc_id>:<run>`` is a
    multiple of it, the one at checksum modulo length. Null texts have no words; runs of a null
    id are not changed. Long texts are read whole, repeated rows count each.
    """
    short_batches(docs.sparkSession)
    letters = params.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def result() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = Counter(w for w in RUNS.findall(text.encode().translate(LOWER).decode()) if len(w) >= letters)
                if changed and doc is not None:
                    seed = zlib.crc32(f"{doc}:".encode())
                    for word in list(own):
                        h = zlib.crc32(word.encode(), seed)
                        if h % changed == 0:
                            at, n = h % len(word), own.pop(word)
                            if len(word) > letters:
                                counts[word[:at] + word[at + 1 :]] += n
                counts.update(own)
                if len(counts) >= HELD:
                    yield result()
        if counts:
            yield result()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points between the marks) of the words of each length."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        place = np.flatnonzero(sizes == size)
        codes = np.empty((len(place), size + 2), np.uint64)
        codes[:, 0], codes[:, -1] = START, END
        codes[:, 1:-1] = np.frombuffer("".join([words[k] for k in place]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(place), size)
        yield place, codes


def gram_marks(codes: np.ndarray, length: int) -> np.ndarray:
    """Marks of the grams of ``length`` at each place."""
    n = codes.shape[1] - length + 1
    out = np.zeros((len(codes), max(n, 0)), np.uint64)
    if n > 0:
        for k in range(length):
            out = out * BASE + codes[:, k : k + n]
    return mix(out + np.array([length], np.uint64) * OTHER)


def dictionary(words: DataFrame, params: Params) -> np.ndarray:
    """Marks of the frequent grams, ascending: at most ``nodes`` of each length, whatever the number of words."""
    short_batches(words.sparkSession, 4096)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [gram_marks(codes, q).ravel() for _, codes in by_length(texts) for q in range(params.shortest, params.longest)]
            marks, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(marks.view(np.int64)), pa.array(n, pa.int64())], ["mark", "n"])

    places = words.agg(F.sum(F.length("word") + 3 - params.shortest)).first()[0] or 0
    most = places // params.nodes
    counts = words.select("word").mapInArrow(run, "mark long, n long").groupBy("mark").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    return np.sort(counts.select("mark").toArrow().column(0).to_numpy().view(np.uint64))


def gram_ends(codes: np.ndarray, frequent: np.ndarray, params: Params) -> np.ndarray:
    """End of the gram at each place, 0 where none starts or an earlier one holds it."""
    m, n = codes.shape
    starts = n - params.shortest + 1
    ends = np.arange(starts)[None, :] + params.shortest + np.zeros((m, 1), np.int64)
    grows = np.ones((m, starts), bool)
    for q in range(params.shortest, params.longest):
        room = max(n - q, 0)  # places with one more character behind the gram
        marks = gram_marks(codes, q)[:, :room]
        at = np.minimum(np.searchsorted(frequent, marks), max(len(frequent) - 1, 0))
        grows[:, room:] = False
        grows[:, :room] &= frequent[at] == marks if len(frequent) else False
        ends += grows
    held = np.maximum.accumulate(ends, axis=1)
    ends[:, 1:][ends[:, 1:] <= held[:, :-1]] = 0
    return ends


def cuts(ends: np.ndarray, n: int, params: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, left, right) for the distinct sets of unaffected grams: those of the first ``left`` and from ``right`` on.

    A gram that ends at ``e`` is not affected by an edit at ``e`` or behind, nor by one before ``e - longest``:
    from there on an earlier gram can reach its end.
    """
    m, starts = ends.shape
    row, p = np.nonzero(ends)
    e = ends[row, p]
    left = np.zeros((m, n + 1), np.int64)
    left[row, e] = e
    left = np.maximum.accumulate(left, axis=1)
    right = np.full((m, n + 1), n)
    behind = e >= params.longest
    right[row[behind], e[behind] - params.longest] = p[behind]
    right = np.minimum.accumulate(right[:, ::-1], axis=1)[:, ::-1]
    # an insertion before place i, and a change or a deletion of the character at i; the marks stay
    pairs = np.concatenate([left[:, 1:n] * (n + 1) + right[:, 1:n], left[:, 1 : n - 1] * (n + 1) + right[:, 2:n]], axis=1)
    pairs.sort(axis=1)
    new = np.ones(pairs.shape, bool)
    new[:, 1:] = pairs[:, 1:] != pairs[:, :-1]
    word, at = np.nonzero(new)
    found = pairs[word, at]
    return word, found // (n + 1), found % (n + 1)


def keys(codes: np.ndarray, word: np.ndarray, left: np.ndarray, right: np.ndarray, base: np.uint64) -> np.ndarray:
    """64 bits of the characters before ``left`` and from ``right`` on, with their numbers."""
    m, n = codes.shape
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base)]))
    ahead, back = np.zeros((m, n + 1), np.uint64), np.zeros((m, n + 1), np.uint64)
    np.cumsum(codes * powers, axis=1, out=ahead[:, 1:])
    back[:, :-1] = np.cumsum(codes[:, ::-1] * powers, axis=1)[:, ::-1]
    return mix(mix(ahead[word, left] + left.astype(np.uint64) * OTHER) * base + mix(back[word, right] + (n - right).astype(np.uint64) * BASE)).view(np.int64)


def postings(words: DataFrame, frequent: np.ndarray, params: Params) -> DataFrame:
    """(key, other_key, id, n, part) of every set of unaffected grams of every word; ``part`` is what lies between them."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)
    short_batches(words.sparkSession, 2048)
    columns = "key long, other_key long, id long, n long, part string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, n = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for place, codes in by_length(texts):
                word, left, right = cuts(gram_ends(codes, shared.value, params), codes.shape[1], params)
                marked = [f"\x01{texts[k]}\x02" for k in place]
                parts = [marked[w][a:b] for w, a, b in zip(word.tolist(), left.tolist(), right.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys(codes, word, left, right, BASE)), pa.array(keys(codes, word, left, right, OTHER)),
                    pa.array(ids[place][word]), pa.array(n[place][word]), pa.array(parts, pa.string())], [c.split()[0] for c in columns.split(", ")])

    return words.select("id", "word", "n").mapInArrow(run, columns)


def near_words(words: DataFrame, params: Params) -> DataFrame:
    """(id, other, other_n) of all ordered pairs of ``words`` (id, word, n) that one edit turns into each other."""
    rows = postings(words, dictionary(words, params), params)
    other = rows.select("key", "other_key", F.col("id").alias("other"), F.col("n").alias("other_n"), F.col("part").alias("other_part"))
    pairs = rows.join(other, ["key", "other_key"]).where((F.col("id") != F.col("other")) & (F.levenshtein("part", "other_part", 1) == 1))
    return pairs.select("id", "other", "other_n")


def variants(counts: DataFrame, params: Params = Params()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``counts`` (word, n) that are long and frequent enough.

    Words are near if exactly one inserted, deleted or replaced code point turns one into the other. A word's form is its
    near word of the largest ``n`` (ties: the first in code-point order) if that is ``factor`` times the word's own
    or more; its root is the last word that forms lead to. Null words and counts are left out; rows of one word are added
    up, other columns ignored. A table without such words gives an empty result.
    """
    kept = counts.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= params.repeats) & (F.char_length("word") >= params.least))
    # ids ascend with the words, so they decide ties
    words = stored(kept.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")
    near = near_words(words, params).repartition("id").dropDuplicates(["id", "other"])
    best = near.groupBy("id").agg(F.count("*").alias("n_near"), F.max(F.struct("other_n", (-F.col("other")).alias("back"))).alias("best"))
    found = stored(best.select("id", "n_near", (-F.col("best.back")).alias("other"), F.col("best.other_n").alias("other_n")), "spelling-near")
    linked = words.join(found, "id", "left").select("id", "word", "n", "n_near", *[F.when(F.col("other_n") >= params.factor * F.col("n"), F.col(c)).alias(c) for c in ("other", "other_n")])
    linked = stored(linked, "spelling-linked")
    roots = followed(linked.where("other IS NOT NULL").select("id", "other"))
    names = words.select("id", "word")
    named = roots.join(names.select(F.col("id").alias("other"), F.col("word").alias("form")), "other").join(names.select(F.col("id").alias("last"), F.col("word").alias("root")), "last")
    out = linked.join(named.select("id", "form", "root"), "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("other_n").alias("form_n"))


def followed(forms: DataFrame) -> DataFrame:
    """(id, other, last) of ``forms`` (id, other) with the end of each chain.

    Counts grow by the factor with every step, so chains are short: as many rounds as the longest has steps, over rows that still move.
    """
    step = forms.select(F.col("id").alias("last"), F.col("other").alias("further"))
    now, done = forms.withColumn("last", F.col("other")), []
    while True:
        moved = stored(now.join(step, "last", "left"), "spelling-steps")
        done.append(moved.where("further IS NULL").select("id", "other", "last"))
        now = moved.where("further IS NOT NULL").select("id", "other", F.col("further").alias("last"))
        if now.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
