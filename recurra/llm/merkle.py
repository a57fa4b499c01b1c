"""Document fingerprints as Merkle trees over sections, paragraphs and pieces of paragraphs.

A paragraph is a line; long ones are cut into pieces after words chosen by their hash,
so a change moves no other cut. A section ends after a paragraph chosen by its hash.
The fingerprint holds the root and the hashes of the pieces; inner hashes follow from
these. Equal roots mean equal texts, and where roots differ, only differing branches
are walked down to find the edit.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import short_batches, text_or_empty
from recurra.llm.textarrays import run_hashes, runs, utf8

NEWLINE = 10
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LEAST = -(1 << 63)


@dataclass(frozen=True)
class Params:
    #: one of so many words ends a piece, one of so many paragraphs a section
    piece: int = 16
    section: int = 4
    #: of the first words of each paragraph one of fewer ends a piece, so that short texts have several
    head: int = 64
    head_piece: int = 4


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


@dataclass
class Tree:
    """Root and pieces of one text; ``sections`` holds paragraphs, which hold 4-byte piece hashes."""

    root: bytes
    sections: list[list[bytes]]

    @property
    def fingerprint(self) -> str:
        return self.root.hex() + "|" + "|".join([";".join([p.hex() for p in s]) for s in self.sections])

    @classmethod
    def parse(cls, text: str) -> Tree:
        root, *sections = text.split("|")
        return cls(bytes.fromhex(root), [[bytes.fromhex(p) for p in s.split(";")] for s in sections if s])


def trees(texts: list[str], params: Params = Params()) -> list[Tree]:
    """Tree of each text; cuts and hashes of all texts are found together."""
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    start, end, _ = runs((~SPACES[data]).astype(np.uint8), offsets)
    opens = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == NEWLINE) + 1]))
    before = np.searchsorted(start, opens)  # words before each paragraph
    nth = np.arange(len(start)) - before[np.searchsorted(opens, start, side="right") - 1]
    chosen = end[run_hashes(data, start, end) % np.where(nth < params.head, params.head_piece, params.piece).astype(np.uint64) == 0]
    cuts = np.unique(np.concatenate([opens, chosen]))
    cuts = cuts[cuts < len(data)]
    stops = np.append(cuts[1:], len(data))[: len(cuts)]
    hashes = run_hashes(data, cuts, stops).astype("<u8")
    closes = data[stops - 1] == NEWLINE if len(stops) else np.zeros(0, bool)
    bounds = np.searchsorted(cuts, offsets)
    long, short = hashes.tobytes(), (hashes >> np.uint64(32)).astype("<u4").tobytes()
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        ends = (np.flatnonzero(closes[a:b]) + a + 1).tolist()
        if b > a and (not ends or ends[-1] != b):
            ends.append(b)
        sections, section, parts, inner = [], [], [], b""
        for e in ends:
            paragraph = digest(long[8 * a : 8 * e])
            section.append(short[4 * a : 4 * e])
            inner += paragraph
            if paragraph[0] % params.section == 0:
                sections.append(section)
                parts.append(digest(inner))
                section, inner = [], b""
            a = e
        if section:
            sections.append(section)
            parts.append(digest(inner))
        out.append(Tree(digest(b"".join(parts)), sections))
    return out


def likeness(a: Tree, b: Tree) -> float:
    """Share of pieces that both have, 1 exactly if the roots are equal. Equal branches are not opened."""
    if a.root == b.root:
        return 1.0
    shared = Counter(map(tuple, a.sections)) & Counter(map(tuple, b.sections))
    x, y, same = Counter(), Counter(), 0
    for tree, pieces in ((a, x), (b, y)):
        known = dict(shared)
        for s in tree.sections:
            if known.get(t := tuple(s)):
                known[t] -= 1
                same += sum(map(len, s)) // 4
            else:
                pieces.update(p[i : i + 4] for p in s for i in range(0, len(p), 4))
    common = same + 2 * sum((x & y).values())
    total = same + sum(x.values()) + sum(y.values())
    return 0.0 if not total else min(common, total - 1) / total


def differing(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """(section, paragraph) of ``a`` whose branches ``b`` does not have."""
    sections = {tuple(s) for s in b.sections}
    paragraphs = {p for s in b.sections for p in s}
    return [(i, k) for i, s in enumerate(a.sections) if tuple(s) not in sections for k, p in enumerate(s) if p not in paragraphs]


def buckets(docs: DataFrame, count: int) -> DataFrame:
    """(bucket, halo, key, text, doc_id): documents dealt by ascending id, so that successors meet.

    The first document of a bucket is also the last (``halo``) of the bucket before, and
    the first of all that of the last bucket. Only bounds and first ids, one for each
    bucket, come to the driver. Null ids come before all others.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(LEAST)))
    marks = [i / count for i in range(1, count)]
    bounds = np.array(sorted(set(rows.agg(F.percentile_approx("key", marks, 10_000)).first()[0] or [])), np.int64)

    def of(keys: pa.Array) -> np.ndarray:
        return np.searchsorted(bounds, keys.to_numpy(zero_copy_only=False), side="left")

    @F.arrow_udf("int")
    def bucket(keys: pa.Array) -> pa.Array:
        return pa.array(of(keys), pa.int32())

    first = {r.b: r.key for r in rows.groupBy(bucket("key").alias("b")).agg(F.min("key").alias("key")).collect()}
    order = sorted(first)
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the last one comes before the first

    @F.arrow_udf("array<int>")
    def homes(keys: pa.Array) -> pa.Array:
        return pa.array([[b, before[b]] if first[b] == k else [b] for k, b in zip(keys.to_pylist(), of(keys).tolist())], pa.list_(pa.int32()))

    return rows.select("doc_id", "key", "text", F.posexplode(homes("key")).alias("halo", "bucket"))


def edited(text: str, following: str) -> str:
    """``text`` whose last half is replaced by as many first code points of ``following``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, params: Params = Params(), tasks: int | None = None) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness.

    The edited text takes its end from the document with the next id; among equal ids,
    null ones included, a hash of the text decides. Null texts are empty; the tree of an
    empty text has no branches. Every row is kept; other columns are ignored; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    short_batches(spark)
    tasks = tasks or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = buckets(docs, tasks).repartition("bucket").sortWithinPartitions("bucket", "halo", "key", F.xxhash64("text"))
    dealt = dealt.select("bucket", "halo", "doc_id", "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_paragraphs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            rows = held + list(zip(*[c.to_pylist() for c in batch.columns]))
            held = rows[-1:]
            pairs = [(x, y) for x, y in zip(rows, rows[1:]) if not x[1] and x[0] == y[0]]
            if not pairs:
                continue
            changed = [edited(x[3], y[3]) for x, y in pairs]
            own = trees([x[3] for x, _ in pairs], params)
            new = trees(changed, params)
            after = trees([pairs[-1][1][3]], params)
            nexts = [own[i + 1] if i + 1 < len(pairs) and pairs[i + 1][0] is y else None for i, (_, y) in enumerate(pairs)]
            nexts = [n or (after[0] if i + 1 == len(pairs) else trees([pairs[i][1][3]], params)[0]) for i, n in enumerate(nexts)]
            yield pa.RecordBatch.from_arrays([
                pa.array([x[2] for x, _ in pairs], pa.int64()), pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]), pa.array([t.fingerprint for t in own]), pa.array([t.fingerprint for t in new]),
                pa.array([likeness(a, b) for a, b in zip(own, new)]), pa.array([likeness(a, b) for a, b in zip(own, nexts)]),
                pa.array([len(differing(a, b)) for a, b in zip(own, new)], pa.int32()),
            ], names)

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_paragraphs int")
