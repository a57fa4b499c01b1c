"""Secrets and personal data: base spans by brute force, added spans on written cases."""

import hashlib
import random
import re

from recurra.llm import pii, secrets

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def secret_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def personal_spans(text):
    def fits(kind, value):
        d = re.sub("[^0-9]", "", value)
        luhn = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0
        return {"email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else 0, "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]

    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PII.items() for m in re.finditer(p, text) if fits(k, m[0]))


def fuzz(parts, n, seed):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_secret_base_by_brute_force(spark, edge, edge_rows):
    rows = fuzz(["token", "TOKEN", "api_key", " ", "=", ": ", '"', "'", "AKIA", "AB12CD34EF56", "0123456789abcdef", "deadbeef", "x", "é🎉", "ſecret", "password", "-", "\n"], 800, 1)
    got = {r.doc_id: r for r in secrets.digests(secrets.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    for i, t in rows:
        assert got[i].base_sha256 == sha(secret_spans(t)), t
        base = ",".join(x for x in got[i].spans.split(",") if not x.startswith("guess"))
        assert base == secret_spans(t)
    assert secrets.digests(secrets.find(edge)).count() == len(edge_rows)


def test_guess_cost_orders_values():
    cost = secrets.guess_cost
    weak = ["password", "Passw0rd", "qwertyuiop", "aaaaaaaaaaaa", "2019-05-12", "changeme", "password123", "required", ""]
    strong = ["x7Gh9qLp2Z", "mF_9.B5f-4.1JqM", "Tr0ub4dor&3"]
    assert max(map(cost, weak)) < secrets.Params.least_cost <= min(map(cost, strong))
    assert cost("password") < cost("passwordpassword") and cost("ab" * 20_000) > 1000  # long values are no special case


def test_guessed_secrets_and_their_redaction(spark, edge, none):
    text = "The pwd is x7Gh9qLp2Z. passphrase: required; see https://me:Tr0ub4dor&3zz@host and token=deadbeefdeadbeefdeadbeefdeadbeef!"
    assert [text[a:b] for _, k, _, a, b in secrets.scan(text) if k == 3] == ["x7Gh9qLp2Z", "Tr0ub4dor&3zz"]
    docs = spark.createDataFrame([(1, text, len(text)), (2, None, 5)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert got[1].text == "The pwd is [SECRET]. passphrase: required; see https://me:[SECRET]@host and token=[SECRET]!"
    assert got[1].n_chars == len(got[1].text) and got[2].text is None and got[2].n_chars == 5
    assert secrets.redact(edge).schema.names == edge.schema.names and secrets.redact(edge).count() == edge.count()
    assert secrets.find(none).count() == 0


def test_credential_names_and_values_as_they_are_written():
    cases = {
        "aws_secret_access_key = wJalrXUtnFEMIK7MDENGbPxRf": "wJalrXUtnFEMIK7MDENGbPxRf", "AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7MDENG": "wJalrXUtnFEMI/K7MDENG",
        "db_pwd: kT9vQz7LmX2p": "kT9vQz7LmX2p", "DB_PASSWORD=abc!defGH12$k": "abc!defGH12$k", "password = P@x7w0Rd2024XyZ!": "P@x7w0Rd2024XyZ",
        "pwd: k7@Zq91mX$w2Lp": "k7@Zq91mX$w2Lp", "password: Winter2024!kx#9Q": "Winter2024!kx#9Q", "password=changeme!x": "changeme!x",
        "Authorization: Bearer kT9vQz7LmX2p": "kT9vQz7LmX2p", "see https://me:Tr0ub4dor&3zz@host": "Tr0ub4dor&3zz",
    }
    for text, value in cases.items():
        assert [text[a:b] for _, k, _, a, b in secrets.scan(text) if k == 3] == [value], text
        assert value not in secrets.redact_text(text) and secrets.redact_text(text).count("[SECRET]") == 1
    assert secrets.redact_text("password: Winter2024!kx#9Q end") == "password: [SECRET] end"
    assert secrets.redact_text("go?token=abcdefgh12&user=bob") == "go?token=[SECRET]&user=bob"
    for text in ("login: anna1@example.com", "my_bypass: kT9vQz7LmX2p", "tokens_used = kT9vQz7LmX2p"):
        assert secrets.redact_text(text) == text
    assert len(secrets.scan("password: " + "ab@1" * 50_000 + " token=" + "deadbeef" * 9000 + "!x")) == 4


def test_contexts_without_colon_or_equals_sign():
    for text in ("BEARER kT9vQz7LmX2p", "Bearer\tkT9vQz7LmX2p", "the password\nis kT9vQz7LmX2p", "Secret IS\tkT9vQz7LmX2p"):
        assert [text[a:b] for _, k, _, a, b in secrets.scan(text) if k == 3] == ["kT9vQz7LmX2p"], text


def test_personal_base_by_brute_force(spark):
    rows = fuzz(["a", "B", "1", "23", "255", "4111111111111111", "@", "@", ".", ".", " ", "-", "+", "+1", "(", ")", "é", "🎉", "a@b.c", "1.2.3.4", "\n", "_", "0001.2.3.4"], 1500, 3)
    rows += [(9000, None), (9001, "a@" + "b.c" * 3000 + " +1" + " " * 5000 + "a" * 20_000)]
    got = {r.doc_id: r for r in pii.digests(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert got[i].base_sha256 == sha(personal_spans(t or "")), t


def test_added_personal_spans(spark, edge, edge_rows, none):
    text = "SSN: 123-45-6789, call (415) 555-1234. Contact Dr. Anna Smith, IBAN DE89 3704 0044 0532 0130 00. Plain words follow."
    docs = spark.createDataFrame([(i, text) for i in range(40)] + [(99, "only words here")], "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find(docs).collect()}
    assert {(k, text[a:b]) for k, a, b in got[0]} == {("local_phone", "(415) 555-1234"), ("national_id", "123-45-6789"), ("account", "DE89 3704 0044 0532 0130 00"), ("name", "Anna Smith")}
    assert got[99] == []
    assert pii.find(edge).count() == len(edge_rows) and pii.digests(pii.find(none)).count() == 0
