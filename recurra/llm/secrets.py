"""Secret scan: fixed patterns, and values in credential contexts judged by the cost of guessing them.

The guess cost of a value is the least total over all ways to cut it into dictionary
words, dates, repeats, keyboard walks and brute-force spans, in powers of ten. It is
found by dynamic programming from left to right; brute force extends by one character
at a time, so the work is linear in the length of the value.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import map_batches, short_batches, text_or_empty

KINDS = ("assign", "access", "hex", "guess")
# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: a credential name, a separator and a value; or user and password in an address, where the value ends at the host
CONTEXT = re.compile(
    r"""(?:(?<![^\W_])(?<!://)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?P<user>credentials?|auth(?:orization)?|login)|bearer|secret[_ -]?access[_ -]?key|(?:api|access|private|secret|client|encryption)[_ -]?(?:key|secret))_?(?![^\W_])["']?\s{0,8}(?:[:=]|\bis\b)\s{0,8}["']?(?:(?:bearer|basic)\s{1,8})?|(?<![^\W_])bearer\s{1,8})(?P<value>[^\s"'<>]{6,})|://[^\s/:@]{1,64}:(?P<password>[^\s"'<>@]{6,})""",
    re.I | re.A)
#: a part of every match of CONTEXT
BEFORE = re.compile(r"pass|pwd|secret|token|credential|auth|login|bearer|key|://", re.I | re.A)
#: addresses name the user where names of logins stand
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.A)
#: the next field of a query string or a list
NEXT_FIELD = re.compile(r"[&,;][A-Za-z_][\w.-]{0,63}[=:]", re.A)
TRAIL = ".,;:!?)]}>"


@dataclass(frozen=True)
class Params:
    #: a value counts as a secret from this many powers of ten of guesses
    least_cost: float = 10.0
    #: price of one more segment: the guesser has to know where it starts
    segment: float = 0.6


# Common words of passwords and of text beside credentials, most frequent first.
WORDS = (
    "password secret token admin user login welcome letmein qwerty monkey dragon master shadow sunshine princess football "
    "baseball superman batman trustno hello freedom whatever test guest root default changeme example sample dummy your "
    "here value string none null true false required enter please reset forgot change new old key api access private "
    "public client server service account name mail email home work love summer winter spring autumn january february "
    "march april june july august september october november december monday friday sunday the and for with not this that "
    "from have will can must should expired invalid missing stored hidden encrypted environment variable config database "
    "production staging development localhost system manager security strong weak simple number random generated placeholder"
).split()
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
LONGEST_WORD = max(map(len, WORDS))
LEET = str.maketrans("4@831!05$7", "aabeiiosst")
KEYBOARD = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
NEXT_KEY = {a + b for row in KEYBOARD for x in (row, row[::-1]) for a, b in zip(x, x[1:])}
DATE = re.compile(r"(?:19|20)\d\d([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d", re.A)


def letter_cost(c: str) -> float:
    """Powers of ten that brute force pays for one character; running text is cheaper than noise."""
    return 0.6 if c.islower() else 0.9 if c.isalpha() else 1.0


def guess_cost(value: str) -> float:
    """Least log10 of guesses over all segmentations of ``value``; 0 for an empty one."""
    n, penalty = len(value), Params.segment
    low = value.lower() if len(value.lower()) == n else value
    plain = low.translate(LEET)
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)  # best cost with a brute-force span still open
    mixed = len({"d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in value}) > 1
    runs, walks = [1] * n, [1] * n  # length of the repeat and of the keyboard walk that ends here
    for i in range(1, n):
        if low[i] == low[i - 1]:
            runs[i] = runs[i - 1] + 1
        if low[i - 1 : i + 1] in NEXT_KEY:
            walks[i] = walks[i - 1] + 1
    spans: dict[int, list[tuple[int, float]]] = {}
    for i in range(n):
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            rank = RANK.get(low[i:j]) or RANK.get(plain[i:j], 0) * 4
            if rank:
                upper = sum(c.isupper() for c in value[i:j])
                spans.setdefault(j, []).append((i, math.log10(rank + 1) + (math.log10(2) * (1 + min(upper, 4)) if upper else 0)))
        if value[i].isdigit() and (m := DATE.match(value, i)):
            spans.setdefault(m.end(), []).append((i, math.log10(365 * 60) if m.end() - i > 4 else math.log10(120)))
    for j in range(1, n + 1):
        c = letter_cost(value[j - 1]) + (0.3 if mixed else 0)
        brute[j] = min(brute[j - 1], best[j - 1] + penalty) + c
        cost = brute[j]
        for i, price in spans.get(j, ()):
            cost = min(cost, best[i] + price + penalty)
        if (k := runs[j - 1]) >= 3:
            cost = min(cost, best[j - k] + letter_cost(value[j - 1]) + math.log10(k) + penalty)
        if (k := walks[j - 1]) >= 4:
            cost = min(cost, best[j - k] + math.log10(47 * k) + penalty)
        best[j] = cost
    return best[n]


def scan(text: str, params: Params = Params()) -> list[tuple[int, int, int, int, int]]:
    """Spans of a text as (start, kind, end, start of the value, end of the value), in order of start and kind."""
    found = []
    context = ":" in text or "=" in text
    if context:
        found += [(m.start(), 0, m.end(), *m.span(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), *m.span()) for m in HEX.finditer(text)]
    if BEFORE.search(text):
        base, taken = sorted((x[3], x[4]) for x in found), 0
        for m in CONTEXT.finditer(text):
            start, value = m.start(m.lastgroup), m[m.lastgroup].rstrip(TRAIL)
            if m["user"] and EMAIL.fullmatch(value):
                value = value[: value.index("@")]
            while taken < len(base) and base[taken][1] <= start:
                taken += 1
            over = []
            for k in range(taken, len(base)):
                if base[k][0] >= start + len(value):
                    break
                if base[k][1] > start:
                    over.append(base[k])
            if over and (field := NEXT_FIELD.search(value)):
                value = value[: field.start()]
            end = start + len(value)
            if end - start < 6 or any(a <= start and end <= b for a, b in over):
                continue
            # what goes on from a base value belongs to it, whatever it costs
            if any(a == start for a, _ in over) or guess_cost(value) >= params.least_cost:
                found.append((start, 3, end, start, end))
    return sorted(found)


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, *_ in spans)


def find(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of every row: (doc_id, spans array of (kind, start, end, value_start, value_end)) in code points.

    Null and empty texts have no spans; every row is kept, repeated and null ids included;
    other columns are ignored.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), *[(n, pa.int32()) for n in ("start", "end", "value_start", "value_end")]]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [[{"kind": KINDS[k], "start": s, "end": e, "value_start": a, "value_end": b} for s, k, e, a, b in scan(t, params)] for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(rows, run, "doc_id long, spans array<struct<kind:string,start:int,end:int,value_start:int,value_end:int>>")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, checksum of the base spans, all spans as text."""
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["kind"] != "guess")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(text(base), 256).alias("base_sha256"), text("spans").alias("spans"))


def redact_text(text: str | None, params: Params = Params(), mark: str = "[SECRET]") -> str | None:
    if not text:
        return text
    out, at = [], 0
    for a, b in sorted((x[3], x[4]) for x in scan(text, params)):
        if b > at:
            out += [text[at : max(a, at)], mark if a >= at else ""]
            at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents with each secret value replaced by a mark; ``n_chars``, if there, follows the text.

    Null texts stay null; all rows and columns stay.
    """
    short_batches(docs.sparkSession)

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        return pa.array([redact_text(t, params) for t in texts.to_pylist()], pa.string())

    out = docs.withColumn("text", cleaned(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
