import random
import re

import pytest

from burnlens.llm import pii

FORMS = [
    "jane { at } corp.org",
    "jane {AT} corp.org",
    "jane [ @ ] corp.org",
    "jane {@} corp.org",
    "jane@corp [ dot ] org",
    "jane@corp[DOT]org",
    "jane AT corp DOT org",
    "jane@corp{.}org",
    "jane ( At ) corp.org",
]


@pytest.mark.parametrize("form", FORMS)
def test_spelled_address_is_found_alone_and_beside_other_marks(form):
    for text in (form, f"Write to {form}, please", f"{form} or [at]"):
        start = text.index("jane")
        assert [(n.start, n.end) for n in pii.candidates(text, [])] == [(start, start + len(form))], text


def test_gate_changes_no_candidate(monkeypatch):
    rnd = random.Random(5)
    parts = ["a", "b-c", "10", ".", "@", "at", "AT", "At", "dot", "DOT", "Dot", "[", "]", "(", ")", "{", "}", " ", " ", "\t", " ", "[.]", "[dot]", " dot ", " at "]
    texts = ["x" + "".join(rnd.choice(parts) for _ in range(rnd.randint(3, 16))) + "y" for _ in range(20_000)]
    texts += ["1" + "".join(rnd.choice([".", "[.]", "(.)", "[dot]", "(DOT)"]) + "1" for _ in range(3)) for _ in range(200)]
    gated = [pii.candidates(t, []) for t in texts]
    monkeypatch.setattr(pii, "MARK", re.compile(""))
    assert gated == [pii.candidates(t, []) for t in texts]
    assert sum(any(n.form == "email" for n in g) for g in gated) > 100


def test_redacted_text_has_no_spelled_address(spark):
    rows = [(k, f"Mail jane@corp.org, or {form} later") for k, form in enumerate(FORMS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.text for r in pii.redact(docs).collect()} == {"Mail [EMAIL], or [EMAIL] later"}
