"""Byte-pair encoding by speculation and verification.

Greedy longest match proposes the tokens of a word. A proposal is right if every
token is reachable by merges and no adjacent pair would have merged across its
border, so all borders of a batch are checked at once with array operations, and
only words with a failing border are merged step by step.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import map_batches, text_or_empty

END = "</w>"
NEVER = np.int64(1) << 40
LONG_WORD = 64
CACHED_RUNS = 500_000
SIGNS = frozenset(".,;:!?|)(")
# Fixed values of the tokenizer: word pattern of its pre-tokenizer.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
SPACES = regex.compile(r"\p{White_Space}+")
#: str.split() also splits at these, which are no white space in Unicode
SEPARATORS = re.compile("[\x1c-\x1f]")


@functools.cache
def byte_letters() -> list[str]:
    """Printable stand-in of each byte: itself if visible Latin-1, else the next free code point from 256."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def folded(text: str) -> str:
    """Normal form of the tokenizer."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class WordBpe:
    """Encoder and decoder for a tokenizer file of the kind "BPE with word ends"."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        size = max(self.tokens) + 1
        self.size = np.int64(size)
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.born = np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            made, x, y = vocab[a + b], vocab[a], vocab[b]
            self.merges[x, y] = rank, made
            self.left[made], self.right[made], self.born[made] = x, y, rank
        keys = np.array([x * size + y for x, y in self.merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array([r for r, _ in self.merges.values()], np.int64)[order]
        made = np.flatnonzero(self.born >= 0)
        made = made[np.argsort(self.born[made])]
        sound = dict.fromkeys(np.flatnonzero(self.born < 0).tolist(), True)
        for t, ok, x, y in zip(made.tolist(), self.compatible(self.left[made], self.right[made], inside=True).tolist(),
                               self.left[made].tolist(), self.right[made].tolist()):
            sound[t] = ok and sound[x] and sound[y]
        codes = {c: b for b, c in enumerate(byte_letters())}
        self.first = np.array([vocab[c] for c in byte_letters()])
        self.last = np.array([vocab[c + END] for c in byte_letters()])
        self.made = np.array([m for _, m in self.merges.values()])
        self.build_trie([(bytes(codes[c] for c in t.removesuffix(END)), t.endswith(END), i) for t, i in vocab.items() if sound[i]])
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.forget()
        self.words = self.repaired = 0

    def build_trie(self, tokens: list[tuple[bytes, bool, int]]) -> None:
        """Trie over the bytes of reachable tokens as sorted edges; a node may end a token inside or at the end of a word."""
        edges: dict[int, int] = {}
        inner, final = {}, {}
        for text, ends_word, token in tokens:
            node = 0
            for b in text:
                node = edges.setdefault(node * 256 + b, len(edges) + 1)
            (final if ends_word else inner)[node] = token
        keys = np.fromiter(edges, np.int64, len(edges))
        order = np.argsort(keys)
        self.edges, self.targets = keys[order], np.fromiter(edges.values(), np.int64, len(edges))[order]
        self.inner_at, self.final_at = np.full(len(edges) + 1, -1), np.full(len(edges) + 1, -1)
        self.inner_at[list(inner)], self.final_at[list(final)] = list(inner.values()), list(final.values())

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = x * self.size + y
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, inside: bool = False) -> np.ndarray:
        """Whether tokens a|b side by side never merge across their border.

        The younger side is taken apart again and again; while a piece lived, the
        border pair must not have had a merge that came before the one which ended it.
        ``inside``: a|b is itself a merge and only earlier ones count.
        """
        x, y = a.astype(np.int64), b.astype(np.int64)
        ok = np.ones(len(x), bool) if inside else self.rank(x, y) == NEVER
        live = np.flatnonzero(ok)
        while live.size:
            bx, by = self.born[x[live]], self.born[y[live]]
            live = live[np.maximum(bx, by) >= 0]
            bx, by = self.born[x[live]], self.born[y[live]]
            west = bx > by
            w, e = live[west], live[~west]
            x[w], y[e] = self.right[x[w]], self.left[y[e]]
            ok[w[self.rank(x[w], y[w]) < bx[west]]] = False
            ok[e[self.rank(x[e], y[e]) <= by[~west]]] = False
            live = live[ok[live]]
        return ok

    def propose(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match for all words at once: every word walks the trie one byte a step.

        Returns the tokens in order of their place and the index of the word of each.
        """
        word, begin, at = np.arange(len(starts)), starts.copy(), starts.copy()
        node, token, stop = np.zeros(len(starts), np.int64), np.full(len(starts), -1), starts.copy()
        found = []
        while word.size:
            inside = at < ends[word]
            key = node * 256 + data[np.minimum(at, len(data) - 1)]
            slot = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            step = inside & (self.edges[slot] == key)
            node, at = np.where(step, self.targets[slot], node), at + step
            match = np.where(at < ends[word], self.inner_at[node], self.final_at[node])
            hit = step & (match >= 0)
            token, stop = np.where(hit, match, token), np.where(hit, at, stop)
            out = np.flatnonzero(~step | (at == ends[word]))
            if out.size:
                found.append((word[out], begin[out], token[out]))
                node[out], token[out], at[out], begin[out] = 0, -1, stop[out], stop[out]
                going = np.ones(len(word), bool)
                going[out] = stop[out] < ends[word[out]]
                word, begin, at, node, token, stop = (x[going] for x in (word, begin, at, node, token, stop))
        words, begins, tokens = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(begins, kind="stable")
        return tokens[order], words[order]

    def merge_many(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Exact merging of many short words side by side, lowest rank first and leftmost among equals.

        Returns the ids of all words one after another and their number for each word.
        """
        n, size = len(starts), int((ends - starts).max())
        rows, place = np.arange(n), np.arange(size)
        lens = ends - starts
        ids = self.first[data[np.minimum(starts[:, None] + place, len(data) - 1)]]
        ids[rows, lens - 1] = self.last[data[ends - 1]]
        after, before = np.tile(place + 1, (n, 1)), np.tile(place - 1, (n, 1))
        rank = np.full((n, size), NEVER)
        if size > 1:
            rank[:, :-1] = self.rank(ids[:, :-1], ids[:, 1:])
            rank[place >= lens[:, None] - 1] = NEVER
        gone = place >= lens[:, None]
        live = rows
        while live.size:
            i = rank[live].argmin(1)
            best = rank[live, i]
            live, i, best = (x[best < NEVER] for x in (live, i, best))
            j = after[live, i]
            ids[live, i] = self.made[best]
            gone[live, j], rank[live, j] = True, NEVER
            k = after[live, j]
            after[live, i] = k
            right = k < lens[live]
            before[live[right], k[right]] = i[right]
            rank[live, i] = np.where(right, self.rank(ids[live, i], ids[live, np.minimum(k, size - 1)]), NEVER)
            h = before[live, i]
            left = h >= 0
            rank[live[left], h[left]] = self.rank(ids[live[left], h[left]], ids[live[left], i[left]])
        return ids[~gone].astype("<u4").tobytes(), (~gone).sum(1)

    def merge_long(self, word: bytes) -> list[int]:
        """The same for one long word, through a heap."""
        ids = [*self.first[list(word[:-1])].tolist(), int(self.last[word[-1]])]
        after, before, heap = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids) and (found := self.merges.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], j, ids[j], found[1]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, x, j, y, made = heapq.heappop(heap)
            if ids[i] != x or after[i] != j or ids[j] != y:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Token ids of words: proposals, one check of all borders, exact merging where a border fails."""
        if any(len(w) > LONG_WORD for w in words):
            return [np.array(self.merge_long(w), "<u4").tobytes() if len(w) > LONG_WORD else self.encode_words([w])[0] for w in words]
        if not words:
            return []
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        flat, owner = self.propose(data, starts, ends)
        at = np.flatnonzero(owner[:-1] == owner[1:])
        pairs, back = np.unique(flat[at] * self.size + flat[at + 1], return_inverse=True)
        wrong = np.unique(owner[at[~self.compatible(pairs // self.size, pairs % self.size)[back]]])
        self.words, self.repaired = self.words + len(words), self.repaired + len(wrong)
        cuts = (np.searchsorted(owner, np.arange(len(words) + 1)) * 4).tolist()
        packed = flat.astype("<u4").tobytes()
        out = [packed[a:b] for a, b in zip(cuts, cuts[1:])]
        lens = (ends - starts)[wrong]
        for low, high in ((0, 12), (12, 24), (24, LONG_WORD)):
            if (part := wrong[(lens > low) & (lens <= high)]).size:
                merged, sizes = self.merge_many(data, starts[part], ends[part])
                cuts = np.concatenate([[0], np.cumsum(sizes) * 4]).tolist()
                for k, a, b in zip(part.tolist(), cuts, cuts[1:]):
                    out[k] = merged[a:b]
        return out

    def pieces(self, runs: list[str]) -> list[list[str | int]]:
        """Words of each run without white space; special tokens as ids."""
        # a line break joins with nothing, so all runs are folded at once
        joined = "\n".join(runs)
        out = []
        for run, plain in zip(runs, (joined.lower() if joined.isascii() else folded(joined)).split("\n")):
            # most runs are one word, or one word and a sign
            if plain.isalpha():
                out.append([plain])
            elif plain[-1:] in SIGNS and plain[:-1].isalpha():
                out.append([plain[:-1], plain[-1]])
            elif self.specials and "<|" in run:
                out.append([])
                for part in self.specials.split(run):
                    out[-1] += [self.special[part]] if part in self.special else WORDS.findall(folded(part))
            else:
                out.append(WORDS.findall(plain))
        return out

    def forget(self) -> None:
        """Empty the stores of runs and words."""
        self.cache: dict[str, bytes] = {}
        self.known: dict[str | int, bytes] = {i: i.to_bytes(4, "little") for i in self.special.values()}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        Words never span white space, so runs without it are encoded once and kept, and so are
        their words; both stores have a fixed size and are started anew when full.
        """
        runs = [[x for x in SPACES.split(t) if x] if SEPARATORS.search(t) else t.split() for t in texts]
        if max(len(self.cache), len(self.known)) > CACHED_RUNS:
            self.forget()
        cache, known = self.cache, self.known
        fresh = list(set().union(*runs).difference(cache))
        cut = self.pieces(fresh)
        words = list(set().union(*cut).difference(known))
        raw = [w.encode() for w in words]
        short = [i for i, w in enumerate(raw) if len(w) <= LONG_WORD]
        known |= zip([words[i] for i in short], self.encode_words([raw[i] for i in short]))
        if len(short) < len(words):
            long = [i for i, w in enumerate(raw) if len(w) > LONG_WORD]
            known |= zip([words[i] for i in long], self.encode_words([raw[i] for i in long]))
        cache |= {c: known[p[0]] if len(p) == 1 else b"".join([known[w] for w in p]) for c, p in zip(fresh, cut)}
        return [b"".join([cache[x] for x in r]) for r in runs]

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by a space, as a tokenizer without a decoder writes them; unknown ids are left out."""
        return " ".join([self.tokens[i] for i in ids.tolist() if i in self.tokens])

    def text(self, ids: np.ndarray) -> str:
        """Readable text: bytes of the tokens, a space after each word."""
        codes = {c: b for b, c in enumerate(byte_letters())}
        out = bytearray()
        for i in ids.tolist():
            token = self.tokens.get(i, "")
            if token in self.special:
                out += token.encode() + b" "
                continue
            out += bytes(codes[c] for c in token.removesuffix(END)) + b" " * token.endswith(END)
        return out.decode("utf-8", "replace").rstrip(" ")


@functools.lru_cache(maxsize=2)
def bpe(path: str) -> WordBpe:
    """One encoder for each Python worker."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encode and decode each text: (doc_id, n_tokens, ids array, decoded).

    Null texts count as empty and give no tokens; every row is kept, null or repeated
    ids included; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = bpe(path)
        ids = [np.frombuffer(x, "<u4") for x in coder.encode(batch.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
            pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array([coder.decode(x) for x in ids]),
        ], ["doc_id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(rows, run, "doc_id long, n_tokens long, ids array<int>, decoded string")


def decode(tokens: DataFrame, path: str, ids: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """Readable text of token id arrays: (doc_id, text). Null arrays give an empty text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = bpe(path)
        texts = [coder.text(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(ids).cast("array<long>"), F.array().cast("array<long>")).alias("ids"))
    return map_batches(rows, run, "doc_id long, text string")


def digests(encoded: DataFrame) -> DataFrame:
    """Checksums of :func:`encode`: ids joined by one space and the decoded text, as SHA-256."""
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select("doc_id", "n_tokens", F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
