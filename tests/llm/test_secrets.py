import hashlib
import random
import re

from venuelens.llm import secrets

BASE = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}


def brute(text):
    rows = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                rows.append((m.start(), rank, kind, m.end()))
    return sorted(rows)


def written(rows):
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in rows)


ODD = [
    None, "", "token=secret:abcdefghijklmnop", "token=secret=abcdefghijklmnop", "PASSWORD = 'abcdefghijkl'", 'api_key":"0123456789abcdef', "ApiKey:short",
    "AKIA" + "A" * 13, "AKIA" + "A" * 14, "xAKIAAKIA" + "B" * 20, "f" * 15, "F" * 30, "éf" + "0" * 16 + "\U0001f600" + "a" * 20, "deadbeef" * 9000,
    "passwd ==abcdefghijklmn", "secret :  \"abc.def/ghi+jkl=", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1B2" * 9, "AIza" + "x" * 35,
    "https://user:hunter22@host/", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "xoxb-123456789012", "sk_live_" + "0" * 20, "token=" * 3000, "0123456789abcdef " * 3000,
]


def random_texts(seed, n):
    rng = random.Random(seed)
    parts = ["token", "Secret", "passwd", "api", "_", "key", "=", ":", " ", "'", '"', "abcdef012345", "0123456789abcdef", "AKIA", "ABCDEFGH1234", "zz", "é", "."]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_base_spans_match_brute_force(documents):
    texts = ODD + random_texts(1, 500)
    rows = list(enumerate(texts)) + [(2, "AKIA" + "Z" * 20), (2, texts[2]), (None, texts[8]), (None, "b" * 16)]
    got = secrets.report(documents(rows).withColumnRenamed("lang", "grams")).collect()
    want = []
    for d, text in rows:
        found = brute(text)
        want.append((d, *(sum(f[2] == k for f in found) for k in BASE), hashlib.sha256(written(found).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        if r.doc_id is not None and r.doc_id != 2:
            base = written(brute(rows[r.doc_id][1])).split(",")
            spans = r.spans.split(",")
            assert [s for s in spans if s.split(":")[0] in BASE] == [b for b in base if b]
    kinds = {i: {s.split(":")[0] for s in r.spans.split(",")} for r in got if (i := r.doc_id) is not None}
    for i, kind in ((16, "private_key"), (17, "github"), (18, "google"), (19, "login_url"), (20, "web_token"), (21, "slack"), (22, "stripe")):
        assert kind in kinds[i]


def test_queries_of_trigrams():
    assert secrets.trigram_query("abc") == [frozenset({"abc"})]
    assert secrets.trigram_query("ab(?:cd|EF)x") == [frozenset({"abc", "bcd", "cdx"}), frozenset({"abe", "bef", "efx"})]
    assert secrets.trigram_query("(?:abcd|abc)y?") == [frozenset({"abc"})]
    assert secrets.trigram_query("[0-9a-f]{16,}") is None and secrets.trigram_query("a.c|abc") is None
    assert secrets.trigram_query("abc.*xyz") == [frozenset({"abc", "xyz"})]
    assert secrets.trigram_query("(?:abc)+d") == [frozenset({"abc"})]
    assert {len(q) for q in secrets.trigram_query(secrets.BASE[0].pattern)} == {3, 4, 5, 6}


def test_every_match_holds_an_alternative():
    rng = random.Random(9)
    for rule in (*secrets.BASE, *secrets.ADDED):
        query = secrets.trigram_query(rule.pattern)
        for text in ODD + random_texts(rng.random(), 300):
            for m in re.finditer(rule.pattern, text or ""):
                low = m[0].lower()
                assert query is None or any(all(g in low for g in grams) for grams in query)


def test_empty_table(documents):
    assert secrets.report(documents([])).count() == 0
