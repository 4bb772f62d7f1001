"""Spans against Python's own matcher, the checksums, the scores, and redaction."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tarmac.llm import pii


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


def iban(m):
    if not re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", m):
        return False
    return int("".join(str(int(c, 36)) for c in m[4:] + m[:4])) % 97 == 1


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ("iban", r"[A-Za-z0-9]{15,}", iban),
    ("ssn", r"[0-9][0-9-]*", lambda m: re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", m) is not None),
]


def plain(text):
    text = text or ""
    out = []
    for kind, pattern, check in PLAIN:
        known = next(k for k in pii.KINDS if k.name == kind)
        for m in re.finditer(pattern, text):
            if check(m.group()):
                near = text[max(0, m.start() - pii.NEARBY) : m.start()]
                word = re.search(rf"(?:^|[^a-z])(?:{known.words})(?:[^a-z]|$)", near, re.I | re.A)
                score = min(100, known.score + pii.WORD_BONUS * bool(word))
                if known.base or score >= pii.LEAST_SCORE:
                    out.append((kind, m.start(), m.end(), score))
    return out


def spans(docs):
    return [(r.text, [tuple(s) for s in r.spans]) for r in pii.find_spans(docs).collect()]


TEXTS = [
    None, "", "a@b.c", "a@b.c_x@y.z", "é😀 mail me: x.y+z@d-e.f.g. and foo@bar @x.y a@.b", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 10255.1.1.1",
    "0000255.00.1.1 1.2.3", "card 4111 1111 1111 1111, 4111-1111-1111-1112", "4111  1111 1111 1111", "41111111111111113" * 2,
    "call +44 (0)20 7946 0958 or +1-2 +1 ((((2", "+1" + "(" * 500, "+12345678+12345678", "IBAN GB82WEST12345698765432 and GB82WEST12345698765433",
    "xGB82WEST12345698765432", "ssn 123-45-6789", "123-45-6789", "ssn 1123-45-6789", "4" * 50000, "a" * 50000 + "@", "1." * 20000,
    "a.b-" * 9000 + "@x.yz", "4111 1111 1111 1111 +4111111111111111", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0" * 300,
]


def test_spans_of_all_shapes(make_docs):
    for text, found in spans(make_docs([(i, t) for i, t in enumerate(TEXTS)])):
        assert found == plain(text), (text or "")[:80]


@pytest.mark.parametrize("alphabet", ["0123456789 -.+()", "ab@.-_1 +", "4105 -", "AB19 ssn-"])
def test_random_texts(make_docs, alphabet):
    rnd = random.Random(alphabet)
    rows = [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.choice([5, 30, 120])))) for i in range(400)]
    for text, found in spans(make_docs(rows)):
        assert found == plain(text), text


def test_redaction(make_docs):
    rows = [(None, "mail é a@b.c now"), (1, None), (1, "nothing"), (2, "call +41111111111111 ok"), (3, "4111 1111 1111 1111")]
    docs = make_docs(rows).withColumns({"spans": F.lit("clash"), "body": F.lit(1)})
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted((r.text or "" for r in out.collect())) == ["", "[CARD]", "call [PHONE] ok", "mail é [EMAIL] now", "nothing"]
    assert {r.spans for r in out.collect()} == {"clash"}


def test_many_spans(make_docs):
    """More spans than one block holds, some within others, with text between; places and redaction as of a plain search."""
    parts = [f"é{i} a{i}@b.c, +4111111111111{i:05} 4111 1111 1111 1111 1.2.3.{i % 300}" for i in range(700)]
    text = " mail ".join(parts)
    docs = make_docs([(1, text), (2, "x"), (3, None)])
    assert dict(spans(docs))[text] == plain(text)
    out, at = [], 0
    for kind, start, end, _ in sorted(plain(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
    redacted = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert redacted == {1: "".join(out) + text[at:], 2: "x", 3: None}


def test_words_nearby_count_whole(make_docs):
    texts = ["shipping 1.2.3.4", "ip 1.2.3.4", "IP: 1.2.3.4", "adresse 1.2.3.4", "tarjeta 4111 1111 1111 1111"]
    found = {t: [s[3] for s in f] for t, f in spans(make_docs(list(enumerate(texts))))}
    assert [found[t] for t in texts] == [[50], [80], [80], [80], [100]]


def test_empty(make_docs):
    assert pii.find_spans(make_docs([])).count() == 0
    assert pii.redact(make_docs([])).count() == 0
