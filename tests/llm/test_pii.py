"""Personal data: base spans against a brute-force search, redaction, learning."""

import hashlib
import random
import re

import pytest

from hourglass.llm import pii
from llm_edge import EDGE


def digits(m):
    return re.sub("[^0-9]", "", m)


def luhn(d):
    doubled = [int(x) * (1 + i % 2) for i, x in enumerate(reversed(d))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]


def brute(text):
    found = [(m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if ok(m.group())]
    return [f"{name}:{a}:{b}" for a, _, b, name in sorted(found)]


def redacted(text):
    out, done = "", 0
    for x in brute(text):
        kind, a, b = x.split(":")
        if int(a) >= done:
            out += text[done:int(a)] + f"[{kind.upper()}]"
        done = max(done, int(b))
    return out + text[done:]


def texts():
    rng = random.Random(3)
    parts = ["a", "b@c.de", "1", "12", "4", "+", "@", " ", "-", ".", "(", ")", "x.y", "é", "\U0001f642", "\n", "1.2.3.4", "256.1.1.1", "01.002.3.255",
             "4111111111111111", "4111 1111 1111 1111", "+1 415 555 2671", "+49 (30) 1234-5678", "j (at) h [dot] com", "_", "%"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1500)]
    return [(100 + i, t) for i, t in enumerate(made + ["a@b.co " * 700, "1." * 2000, "+1 " * 2000, "a." * 500 + "@b", "x@" + "a." * 500 + "b"])]


@pytest.fixture(scope="module")
def nothing_added():
    return pii.Model(thresholds=dict.fromkeys(pii.KINDS))


def test_base_spans_equal_brute_force(frame, nothing_added):
    rows = EDGE + texts()
    for r in pii.find(frame(rows), nothing_added).collect():
        assert [f"{x.kind}:{x.start}:{x.end}" for x in r.pii if x.base] == brute(r.text), r.text
        assert all((r.text.replace("\x01", "\x02"))[x.start:x.end] == x.text for x in r.pii)


def test_redaction_covers_every_span(frame, nothing_added):
    got = pii.redact(frame(texts()), nothing_added).collect()
    assert all(r.text == redacted(dict(texts())[r.doc_id]) for r in got)
    assert [r.text for r in pii.redact(frame([(1, None), (2, "")]), nothing_added).orderBy("doc_id").collect()] == [None, ""]


def test_query_on_edge_rows_and_empty_tables(frame):
    rows = EDGE + [(50, "mail a@b.co and 10.0.0.1")]
    got = pii.digests(frame(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            text = next(t for i, t in rows if i == r.doc_id)
            assert r.base_sha256 == hashlib.sha256(",".join(brute(text)).encode()).hexdigest()
            assert r.n_email == sum(x.startswith("email") for x in brute(text))
    assert pii.digests(frame([])).collect() == []


def test_trees_add_what_looks_like_personal_data_and_leave_the_rest(frame):
    """Addresses written with brackets are learned from their format; years,
    prices and dates stay."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(600):
        rows.append((i, f"write to {word()}@{word()}.com or {word()} (at) {word()} (dot) org by 12.05.2024, about 1999 2000 2001 things 3.50"))
    model = pii.fit(frame(rows))
    assert model.thresholds["email"] is not None and model.thresholds["phone"] is None
    for r in pii.find(frame(rows[:30]), model).collect():
        assert [x.kind for x in r.pii] == ["email", "email"] and [x.base for x in r.pii] == [True, False]
        assert "(dot) org" in r.pii[1].text


def test_base_spans_do_not_pay_for_wrong_additions(frame):
    """Many sure phone numbers, and few numbers that are none: the thresholds
    are for the latter alone."""
    rows = [(i, "call " + ", ".join(f"+1 415 555 {2000 + (i * k) % 7000}" for k in range(1, 7)) + (" values 1999 2000 2001" if i % 100 == 0 else ""))
            for i in range(1500)]
    model = pii.fit(frame(rows))
    assert model.thresholds["phone"] is None and model.thresholds["card"] is None
    assert all(x.base for r in pii.find(frame(rows), model).collect() for x in r.pii)


def test_boosting_learns_an_interaction():
    cells = [{"kind": 0, **dict.fromkeys(pii.FEATURES, 0), "size": a, "cue": b, "n": 100, "positives": 95 if a and b else 5}
             for a in (0, 1) for b in (0, 1)]
    model = pii.Model(*pii.boost(cells))
    assert all((model.score(c) > 0) == (c["positives"] > 50) for c in cells)


def test_plan_is_native(frame, nothing_added):
    plan = pii.find(frame(EDGE), nothing_added)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
