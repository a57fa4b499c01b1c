"""Personal data by weak supervision: labelers vote on candidate spans, expectation
maximisation learns how far each can be trusted, and a span classifier is trained on
the resulting probabilities. Everything is a DataFrame expression.

Candidates come from patterns. Four labelers vote +1, -1 or 0 on each: whether the
value is well formed, a gazetteer of prefixes, endings and names, words around it, and
whether it stands free. Base kinds are reported wherever well formed; candidates of
the other kinds where the classifier accepts them and no base span overlaps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recurra.llm.common import stored, text_or_empty
from recurra.llm.quality_rules import let

BASE = ("email", "ip", "card", "phone")
ADDED = ("local_phone", "national_id", "account", "name")
KINDS = BASE + ADDED
LABELERS = ("form", "gazetteer", "context", "border")
# The patterns. Possessive repeats and the look-behinds only keep the work
# linear; they match what the plain patterns match, as a run of signs never has to be cut.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local_phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.\x20][0-9]{4}(?![0-9-])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<=\b(?:Mr|Ms|Dr|Mrs|Herr|Frau|Prof)\.?\x20)[A-Z][a-z]{1,30}(?:\x20[A-Z][a-z]{1,30}){0,2}+",
}
#: a cheap test that every text with a match passes
HINTS = {
    "email": "@", "phone": "+", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "local_phone": r"[0-9]{3}[-.\x20][0-9]{4}",
    "national_id": r"[0-9]-[0-9]{2}-[0-9]", "account": r"[A-Z]{2}[0-9]{2}", "name": r"\b(?:M[rs]s?|Dr|Herr|Frau|Prof)\b",
}
ENDINGS = "com org net edu gov int io de fr es uk eu us ch at it nl be pl info biz".split()
CALLING = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|33|49|34|44)"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[04-8]|6(?:011|4|5|2))"
FIRST_NAMES = ("James Mary John Anna Michael Maria David Sarah Thomas Laura Robert Julia Peter Paul Hans Klaus Sabine Jean Marie Pierre "
               "Carlos Juan Jose Carmen Ana Luis Elena Emma Lucas Louis Claire Martin Andrea Stefan Sophie").split()
NEAR = {
    "email": r"mail|contact|write|adress|address|correo|courriel", "ip": r"\bip\b|host|server|address|login from|client", "card": r"card|visa|master|credit|payment|karte|tarjeta|carte",
    "phone": r"phone|tel|call|mobile|fax|contact|anruf|llam", "local_phone": r"phone|tel|call|mobile|fax|contact", "national_id": r"ssn|social security|insurance|tax",
    "account": r"iban|account|bank|konto|cuenta|compte", "name": r"name|contact|dear|from|sincerely|regards",
}
AGAINST = {
    "ip": r"version|release|section|chapter|\bv$", "card": r"order|invoice|serial|isbn|hash|commit|token", "phone": r"version|score|temperature", "local_phone": r"order|part|serial|version",
    "national_id": r"part|serial|model|order", "account": r"serial|model|version", "email": r"package|version|scope", "name": r"street|avenue|chapter",
}
SPAN = "struct<kind:string,start:int,end:int,value:string,before:string,after:string>"


@dataclass(frozen=True)
class Params:
    rounds: int = 25
    steps: int = 200
    rate: float = 1.0
    accept: float = 0.5
    #: pseudo-votes for a labeler being right, and for it being wrong
    right: float = 4.0
    wrong: float = 1.0


def matches(text: Column, kind: str) -> Column:
    """All matches of one pattern, left to right, with places in code points and some text around them."""
    pattern, hint = PATTERNS[kind], HINTS[kind]
    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def walk(p: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            start = s["at"] + F.length(F.get(p["gaps"], i))
            value = F.get(p["found"], i)
            span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
                            F.lower(F.right(F.get(p["gaps"], i), F.lit(40))).alias("before"), F.left(F.get(p["gaps"], i + 1), F.lit(12)).alias("after"))
            return F.struct((start + F.length(value)).alias("at"), F.concat(s["out"], F.array(span)).alias("out"))

        none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        return F.when(F.size(p["found"]) > 0, F.aggregate(F.sequence(F.lit(0), F.size(p["found"]) - 1), none, step)["out"]).otherwise(none["out"])

    there = text.contains(hint) if len(hint) == 1 else text.rlike(hint)
    return F.when(there, let(parts, walk)).otherwise(F.array().cast(f"array<{SPAN}>"))


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def well_formed(s: Column) -> Column:
    value = s["value"]
    part = lambda x: let(F.regexp_replace(x, "^0+", ""), lambda d: (F.length(d) <= 3) & (F.coalesce(F.when(F.length(d).between(1, 3), d).cast("int"), F.lit(0)) <= 255))
    digits = F.regexp_replace(value, "[^0-9]", "")
    return (F.when(s["kind"] == "ip", F.forall(F.split(value, r"\."), part))
            .when(s["kind"] == "card", let(digits, lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False))))
            .when(s["kind"] == "phone", F.length(digits).between(9, 15)).otherwise(F.lit(True)))


def sign(yes: Column, no: Column | None = None) -> Column:
    other = F.lit(-1) if no is None else F.when(F.coalesce(no, F.lit(False)), -1).otherwise(0)
    return F.when(F.coalesce(yes, F.lit(False)), 1).otherwise(other)


def votes(s: Column) -> Column:
    """Array of the four votes on a span."""
    value, kind = s["value"], s["kind"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    known = {
        "email": F.lower(F.regexp_extract(value, r"\.([A-Za-z0-9-]+)$", 1)).isin(*ENDINGS), "ip": ~value.rlike(r"^(?:0|127|22[4-9]|2[3-5][0-9])\."),
        "card": digits.rlike(ISSUERS), "phone": value.rlike(CALLING), "local_phone": digits.rlike("^[2-9][0-9]{2}[2-9]"),
        "national_id": ~value.rlike("^(?:000|666|9)|-00-|-0000$"), "account": value.rlike("^(?:DE|FR|ES|GB|IT|NL|BE|AT|CH|PL|PT|SE|DK|NO|FI|IE|LU)"),
        "name": F.split(value, " ")[0].isin(*FIRST_NAMES),
    }
    pick = lambda table: F.coalesce(*[F.when(kind == k, v) for k, v in table.items()])
    words = {k: s["before"].rlike(v) for k, v in NEAR.items()}
    against = {k: s["before"].rlike(v) for k, v in AGAINST.items()}
    joined = s["before"].rlike(r"[\p{L}\p{N}_]$") | s["after"].rlike(r"^[\p{L}\p{N}_]")
    return F.array(sign(well_formed(s)), sign(pick(known)), sign(pick(words), pick(against)), sign(~joined))


def candidates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, spans) of every row with the votes on each span, stored without texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    spans = F.concat(*[matches(F.col("text"), k) for k in KINDS])
    found = rows.select("doc_id", spans.alias("spans"))
    voted = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), votes(s).alias("votes")))
    return stored(found.select("doc_id", voted.alias("spans")), "pii-candidates")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def trained(found: DataFrame, params: Params = Params()) -> DataFrame:
    """(kind, weights): the span classifier, one row for each kind that has candidates.

    Votes are first counted by pattern, 3**4 at most for each kind, and both steps run on
    these counts.
    """
    flat = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes")
    counts = flat.groupBy("kind", "votes").agg(F.count("*").cast("double").alias("n"))
    grouped = counts.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("p"))

    def share(q: Column, j: int, v: Column, positive: bool) -> Column:
        """Smoothed share of vote ``v`` of labeler ``j`` among true or among false spans."""
        mass = lambda x, k: x["n"] * (F.get(q, k) if positive else 1 - F.get(q, k))
        same = total(F.transform(F.filter(F.transform("p", lambda x, k: F.struct(x["votes"][j].alias("v"), mass(x, k).alias("m"))), lambda y: y["v"] == v), lambda y: y["m"]))
        every = total(F.transform("p", mass))
        prior = F.when(v == (1 if positive else -1), params.right).when(v == 0, params.wrong * 2).otherwise(params.wrong)
        return (same + prior) / (every + params.right + 3 * params.wrong)

    def expect(q: Column) -> Column:
        """Probability of each pattern after one round of estimation."""
        n = total(F.transform("p", lambda x: x["n"]))
        prior = (total(F.transform("p", lambda x, k: x["n"] * F.get(q, k))) + 1) / (n + 2)

        def pattern(x: Column) -> Column:
            yes, no = prior, 1 - prior
            for j in range(len(LABELERS)):
                yes, no = yes * share(q, j, x["votes"][j], True), no * share(q, j, x["votes"][j], False)
            return let(F.struct(yes.alias("y"), no.alias("n")), lambda z: z["y"] / (z["y"] + z["n"]))

        return F.transform("p", pattern)

    # the first guess is the majority of votes
    first = F.transform("p", lambda x: 0.5 + F.aggregate(x["votes"], F.lit(0), lambda a, v: a + v) / (2.5 * len(LABELERS)))
    learned = F.aggregate(F.sequence(F.lit(1), F.lit(params.rounds)), first, lambda q, i: expect(q))

    def inputs(v: Column) -> Column:
        return F.concat(F.array(F.lit(1.0)), F.transform(v, lambda x: x.cast("double")))

    def descend(w: Column, q: Column) -> Column:
        n = total(F.transform("p", lambda x: x["n"]))
        errors = F.transform("p", lambda x, k: let(inputs(x["votes"]), lambda z: F.struct(
            z.alias("z"), (x["n"] * (logistic(w, z) - F.get(q, k)) / n).alias("e"))))
        return let(errors, lambda es: F.transform(w, lambda wi, i: wi - params.rate * total(F.transform(es, lambda e: e["e"] * F.get(e["z"], i)))))

    zero = F.array(*[F.lit(0.0)] * (len(LABELERS) + 1))
    fitted = let(learned, lambda q: F.aggregate(F.sequence(F.lit(1), F.lit(params.steps)), zero, lambda w, i: descend(w, q)))
    return grouped.select("kind", fitted.alias("weights"))


def logistic(w: Column, z: Column) -> Column:
    return 1 / (1 + F.exp(-total(F.zip_with(w, z, lambda a, b: a * b))))


def find(docs: DataFrame, params: Params = Params(), text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, spans array of (kind, start, end, score)) of every row, base kinds first, each kind by start.

    Null and empty texts have no spans; null and repeated ids are kept; other columns are
    ignored; an empty table gives an empty result.
    """
    found = candidates(docs, text, id_col)
    model = stored(trained(found, params), "pii-model")
    # one row with a map of at most len(KINDS) entries
    weights = model.agg(F.map_from_entries(F.collect_list(F.struct("kind", "weights"))).alias("w")).scalar()
    neutral = F.array(*[F.lit(0.0)] * (len(LABELERS) + 1))
    rows = found.withColumn("w", weights)
    score = lambda s: logistic(F.coalesce(F.element_at("w", s["kind"]), neutral), F.concat(F.array(F.lit(1.0)), F.transform(s["votes"], lambda x: x.cast("double"))))
    scored = F.transform("spans", lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "votes")], score(s).alias("score")))
    rows = rows.select("doc_id", F.filter(scored, lambda s: s["votes"][0] == 1).alias("spans"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    rows = rows.withColumn("base", base)
    more = F.filter("spans", lambda s: ~s["kind"].isin(*BASE) & (s["score"] >= params.accept) & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.select("doc_id", F.transform(F.concat("base", more), lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "score")])).alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, checksum of the base spans, all spans as text."""
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in BASE],
        F.sha2(text(F.filter("spans", lambda x: x["kind"].isin(*BASE))), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
