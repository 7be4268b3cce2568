import random
import re
import time

import regex

from venuelens.llm import licenses as lic

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def random_texts(seed, n):
    rng = random.Random(seed)
    parts = ["CC", "by", "cc-BY", "general", "Public  license", "all", "rights", "reserved.", "é", "K", "x9", "İ", "_", "word"]
    return [rng.choice([" ", "\n", ", "]).join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def garbled(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        how = rng.randrange(3)
        if how == 0:
            chars[at] = rng.choice("abcxyz")
        elif how == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("abcxyz"))
    return "".join(chars)


def test_base_columns_match_brute_force(documents):
    texts = [None, "", "cc by cc by", "CC-BY", "ccby", "all rights reserved " * 3000, "All\nRights\x00Reserved"] + random_texts(1, 400)
    rows = list(enumerate(texts)) + [(3, "cc by"), (3, "cc by"), (None, "cc by")]
    got = lic.scan(documents(rows).withColumnRenamed("lang", "score")).collect()
    ours = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str)
    assert ours == sorted(((d, *brute(t)) for d, t in rows), key=str)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)


def test_seeded_search_finds_what_a_full_search_finds():
    rng = random.Random(7)
    searcher = lic.Notices()
    for _ in range(150):
        number = rng.randrange(len(lic.NOTICES))
        notice, label = lic.NOTICES[number]
        edits = lic.edits_for(notice)
        made = rng.randrange(edits + 4)
        words = " some words before %s and some after " % " ".join(garbled(rng, notice, made).split())
        full = regex.search(f"(?b)(?:{notice}){{e<={edits}}}", words)
        hits = [h for h in searcher.find(words, lic.Spaces(words.encode("latin-1"))) if h.label == label]
        assert bool(full) == bool(hits)
        if full:
            assert min(h.edits for h in hits) <= max(made, sum(full.fuzzy_counts))


def test_least_edits_match_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        a, b = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 12))), "".join(rng.choice("abc ") for _ in range(rng.randrange(20)))
        row = [0] * (len(b) + 1)
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        assert lic.least_edits(a, b) == min(row)


def test_span_and_score():
    text = " a b licensed undr the apache license version 2 0 c "
    hits = lic.Notices().find(text, lic.Spaces(text.encode()))
    assert [(h.label, h.first_word, h.end_word, h.edits) for h in hits] == [("apache-2.0", 2, 10, 1)]
    assert hits[0].score == 1 - 1 / len(lic.NOTICES[1][0])


def test_edited_notices_beside_unchanged_ones():
    searcher = lic.Notices()
    for notice, label in lic.NOTICES:
        altered = notice[: len(notice) // 2] + "#" + notice[len(notice) // 2 + 1 :]
        size = len(notice.split())
        for order in ([1, 0], [1, 1, 0], [0, 1], [1, 0, 1, 0], [0, 0]):
            text = " a %s b " % " ".join(altered if edits else notice for edits in order)
            hits = searcher.find(text, lic.Spaces(text.encode()))
            assert [h.edits for h in hits if h.label == label] == order
            if altered.count(" ") == notice.count(" "):
                assert [h.first_word for h in hits if h.label == label] == [1 + size * i for i in range(len(order))]


def test_empty_table(documents):
    assert lic.scan(documents([])).count() == 0


def test_many_hits_in_one_text():
    begun = time.time()
    assert lic.scan_text(b"all rights reserved " * 1_000_000)[1:4] == (1_000_000, 0, 2_999_997)
    notice = b"under the terms of the gnu lesser general public license"
    n = 5000
    spans = lic.scan_text(b"".join(notice.replace(b"terms", b"term") + b" x " if i % 3 == 0 else notice + b" " for i in range(n)))[-1].split(",")
    assert sum(s.startswith("lgpl:") for s in spans) == n
    assert time.time() - begun < 60
