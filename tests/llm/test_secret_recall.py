"""Recall on planted keys of several shapes, and how many clean strings are reported, at several thresholds."""

import base64
import random

import pytest

from cratedig.llm.secret_scan import NOVELTY, Novelty, base_spans, novel_spans, secret_report

WORDS = "main return value client config session request handler parse the file load settings user name path buffer index connection".split()
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
CONTEXTS = ["private_key: {}", "Authorization: Bearer {}", "credentials = ['{}']", "auth('{}')", "signature={}&x=1", 'encryption_key = "{}"']
rnd = random.Random(4)
pick = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
KEYS = {
    "base64": lambda: base64.b64encode(rnd.randbytes(32)).decode(),
    "base64 of URLs": lambda: base64.urlsafe_b64encode(rnd.randbytes(32)).decode().rstrip("="),
    "20 letters and digits": lambda: pick(LETTERS, 20),
    "32 letters and digits": lambda: pick(LETTERS, 32),
    "upper-case hex": lambda: pick("0123456789ABCDEF", 32),
    "prefixed": lambda: "tok_" + pick(LETTERS, 36),
    "base32": lambda: pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32),
}
CLEAN = {
    "path": lambda: "/".join(rnd.choice(WORDS) for _ in range(4)) + "/v2",
    "identifier": lambda: "_".join(rnd.choice(WORDS) for _ in range(3)) + "_v2",
    "class name": lambda: "".join(rnd.choice(WORDS).title() for _ in range(3)) + "2Impl",
    "counter": lambda: "name0000000000000001",
    "alphabet": lambda: "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
}


def code(lines):
    return "\n".join("    " + " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(3, 9))) + rnd.choice([":", ";", "()"]) for _ in range(lines))


def planted(make):
    text = f"{code(8)}\n{rnd.choice(CONTEXTS).format('@')}\n{code(8)}"
    at, word = text.index("@"), make()
    return text.replace("@", word), at, at + len(word)


def share(make, least, n=150):
    """How many planted strings the spans cover, and how many of those are wider by more than the padding."""
    novelty, found, tried = Novelty(), 0, 0
    for _ in range(n):
        text, a, b = planted(make)
        base = base_spans(text)
        if not any(x < b and a < y for x, _, y in base):
            tried += 1
            found += any(x <= a and b <= y for x, _, y in novel_spans(text, base, novelty, least))
    return found / tried


@pytest.mark.parametrize("kind", KEYS)
def test_recall(kind):
    assert share(KEYS[kind], NOVELTY) >= 0.9


@pytest.mark.parametrize("kind", CLEAN)
def test_clean_strings(kind):
    assert share(CLEAN[kind], NOVELTY) <= 0.3


def test_threshold_parts_keys_from_clean_strings_best():
    gap = lambda least: sum(share(k, least) for k in KEYS.values()) / len(KEYS) - sum(share(c, least) for c in CLEAN.values()) / len(CLEAN)
    assert gap(NOVELTY) > max(gap(0.6), gap(1.0))


def test_planted_keys_come_through_the_query(spark):
    rows = [(i, *planted(KEYS["base64"])) for i in range(40)]
    got = {r.doc_id: r.spans for r in secret_report(spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")).collect()}
    assert sum(f"novel:{a}:{b}" in got[i].split(",") for i, _, a, b in rows) >= 38
